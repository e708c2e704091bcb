import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from faultline.llm import pieces


@pytest.fixture(scope="module")
def sampler():
    return pieces.Sampler(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_look_up_only_what_may_begin_a_piece(sampler, monkeypatch):
    parts = [" unbelievable", " 9f3ac07be1", " straightforwardly", " zqxjkvwq"]
    hashed = []
    hashes = pieces.Sampler._hashes
    monkeypatch.setattr(pieces.Sampler, "_hashes", staticmethod(lambda sums, start, n: hashed.append(len(start)) or hashes(sums, start, n)))
    sampler._clear()
    sampler._forward(parts)
    assert sum(hashed) < 0.5 * sum(len(p) * (len(p) + 1) // 2 for p in parts)
    found = sorted(sampler._id[: sampler.edges].tolist())
    seen = [p.replace(" ", "▁") for p in parts]
    every = [s[i:j] for s in seen for i in range(len(s)) for j in range(i + 1, len(s) + 1)]
    want = [sampler.piece[x][0] for x in every if x in sampler.piece] + [-ord(" " if c == "▁" else c) - 1 for s in seen for c in s if c not in sampler.piece]
    assert found == sorted(want)


def test_drawn_edges_are_those_of_a_search_of_all_probabilities(sampler):
    texts = pa.array(["the cat sat on the mat 12345", "ünïcode 漢字 text", "", "a"] * 20)
    sampler._clear()
    got, count = sampler.encode(texts, np.arange(80), 3)
    low, ends = sampler._low[: sampler.edges].astype(np.int64), sampler._last[: sampler.parts]
    assert count[2] == 0 and (ends >= 0).all() and (low < 1 << pieces.BITS).all()
    back, where = sampler.decode(got, count)
    assert back.tobytes().decode() == "".join(texts.to_pylist()) and where[-1] == len(back)
    assert len({tuple(got[e - c : e]) for e, c in zip(np.cumsum(count)[::4].tolist(), count[::4].tolist(), strict=True)}) > 1


@pytest.mark.parametrize("top", [0, 1, 70_000, 1 << 33])
def test_order(top):
    values = np.random.default_rng(top).integers(0, top + 1, 5000)
    assert (pieces._order(values) == np.argsort(values, kind="stable")).all()


def test_tasks_leave_no_long_tables_in_their_worker():
    from faultline.llm import textvec
    from faultline.llm.shared import slices, tidy

    batch = pa.RecordBatch.from_pydict({"text": pa.array([f"{i} some words " * 500 for i in range(300)])})

    def run(batches):
        for b in slices(batches, "text"):
            assert len(textvec.Words(b.column("text")).data) <= 1 << 19
            yield b

    assert sum(b.num_rows for b in tidy(run)([batch])) == 300
    assert not textvec._POWERS or len(textvec._POWERS[0]) <= 1 << 16


def test_ids_are_parted_by_stretches_as_at_once(monkeypatch):
    from faultline.llm import wavelet

    rng = np.random.default_rng(2)
    for n, stretch in ((0, 8), (1, 8), (1000, 8), (1000, 1000), (1000, 4096)):
        monkeypatch.setattr(wavelet, "STRETCH", stretch)
        a, b = rng.integers(0, 1 << 10, n).astype(np.uint16), rng.random(n) < 0.3
        got = wavelet.apart(a, b)
        assert (got == np.concatenate([a[~b], a[b]])).all()
        assert (wavelet.together(got, b, 1 << 12) == a + b * np.uint16(1 << 12)).all()
        file = wavelet.pack(a, np.arange(1), np.array([n]), np.ones(1, bool))
        assert (wavelet.Shard(file).all() == a).all()
