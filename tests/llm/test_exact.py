"""Operators with contracts that a short brute-force version can state."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultline.llm import decontam, pieces, pii, sharding, warc, wavelet

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    (0, LONG), (1, None), (2, ""), (3, "!!! ..."), (4, LONG.upper() + "; " + LONG.replace(" ", "\n--")), (5, "Ünë dëux trois 4"), (6, "x " * 3000 + LONG + " y" * 3000), (7, "Ünë  dëux\ttrois 4 Ünë dëux trois 4"),
    (8, LONG), (8, LONG), (None, "null key"), (9, "one two three four five six seven eight nine"), (10, "😀 ▁ a  b \n\n c<|endoftext|>don't 's"),
]
SCHEMA = "doc_id long, text string, y string, n_words int, __x int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "y", 5, 1) for r in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_decontamination(spark, docs, empty):
    items = [(1, LONG), (2, "ünë dëux trois 4"), (3, None), (4, "..."), (10, "ten eleven twelve" + " q" * 9), (11, LONG)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pats = [(str(i), w[j : j + min(10, len(w))]) for i, t in items if (w := words(t)) for j in range(max(1, len(w) - 9))]
    want = collections.Counter()
    for k, t in TEXTS:
        w, hit, found = words(t), set(), set()
        for i, p in pats:
            for j in range(len(w) - len(p) + 1):
                if w[j : j + len(p)] == p:
                    hit |= set(range(j, j + len(p)))
                    found.add(i)
        want[k, len(w), len(hit), tuple(sorted(found))] += 1
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontam.find(docs, bench).collect())
    assert got == want
    assert decontam.find(empty, bench).count() == 0
    assert all(r.n_hit == 0 for r in decontam.find(docs, bench.limit(0)).collect())


def test_wu_manber_in_several_tables(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, LONG), (2, "x x x"), (3, "y y y y y y y y y y y y")], "item_id long, text string")
    key = lambda df: sorted((r.doc_id or -1, r.n_hit, tuple(r["items"])) for r in df.collect())
    one = key(decontam.find(docs, bench))
    monkeypatch.setattr(decontam, "BLOCK", 2)
    assert key(decontam.find(docs, bench)) == one


def test_sharding(docs, empty):
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == len(TEXTS) and sorted(r.row_number for r in rows) == list(range(len(TEXTS)))
    sizes = collections.Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    for r in rows:
        at = sharding.permuted(r.row_number, len(rows), 20240101)
        assert (r.shard, r.slot) == (at % 4, at // 4)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in TEXTS}
    assert sharding.shard(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 1023])
def test_permutation(n):
    assert sorted(sharding.permuted(i, n, 7) for i in range(n)) == list(range(n))


def test_tokens(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = sorted(wavelet.round_trip(docs, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((k for k, _ in TEXTS), key=lambda k: -1 if k is None else k)
    start, texts = 0, collections.defaultdict(list)
    for k, x in TEXTS:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        texts[k].append((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in texts[r.doc_id]
        start += r.n_tokens
    assert wavelet.round_trip(empty, path).count() == 0


def test_tokens_of_added_token_literals(spark, tmp_path):
    from faultline.llm.queries import op7_wavelet_tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["plain text", "one doc<|endoftext|>next", "<|endoftext|>", "a <|endoftext|><|endoftext|> b <|endoftext", "", "|> last one <|endof", "text|>", "é <|endoftext|>\n x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for r in sorted(op7_wavelet_tokens(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = np.array([*t.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert t.encode(texts[1], add_special_tokens=False).ids == [505, 2205, 50256, 19545]


def test_wavelet_matrix():
    ids = np.random.default_rng(0).integers(0, 300, 5000).astype(np.uint32)
    s = wavelet.Shard(wavelet.pack(ids, np.arange(2), np.array([2000, 3000]), np.array([True, False])))
    assert (s.all() == ids).all() and [s.access(i) for i in range(0, 5000, 501)] == ids[::501].tolist()
    for token in (0, 7, 299, 100000):
        at = np.flatnonzero(ids == token).tolist()
        assert s.count(token) == len(at) and s.occurrences(token) == at and s.count(token, 100, 900) == sum(100 <= i < 900 for i in at)
    none = wavelet.Shard(wavelet.pack(ids[:0], np.arange(0), np.arange(0), np.zeros(0, bool)))
    assert len(none.all()) == 0 and none.count(3) == 0


def test_warc(spark):
    big = "<p>" + "ä" * 900
    rows = [(1, "http://a/ b", big), (2, None, big), (5, "http://c", big), (3, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", "x" * 2000), (8, "u", "x" * 2000), (9, "u", "y\r\n\r\nWARC/1.1\r\n" * 200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    got = {r.key: r for r in warc.round_trip(df).where("kind = 'record'").collect()}
    assert len(got) == len(rows)
    for k, _, h in rows:
        raw = (h or "").encode()
        best = max((p for p, _, x in rows if x == h and p is not None), default=None)
        revisit = len(raw) >= 1000 and k != best
        r = got[k]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best if revisit else None)
    assert warc.round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    records = []
    for i in range(12):
        p = bytes([65 + i]) * (500 + 37 * i)
        records.append(warc.record("response", i, f"http://x/{i}", p, hashlib.sha1(p).hexdigest(), None, "2024-01-01T00:00:00Z"))
    parts = [warc.compressed(r) for r in records] if packed else records
    data = bytearray(b"".join(parts))
    offset = np.cumsum([0, *map(len, parts)])
    data[offset[3] + len(parts[3]) // 2] ^= 1
    data[offset[7] + 2 if not packed else offset[7]] ^= 255
    data[offset[8] : offset[8]] = b"\x1f\x8b\x08junk WARC/"
    data = data[:-5]
    found = list(warc.salvage(bytes(data)))
    assert [x.headers["x-row-key"] for x in found if isinstance(x, warc.Record)] == [str(i) for i in range(11) if i not in (3, 7)]
    assert sum(x.length for x in found) == len(data) and all(x.reason for x in found if isinstance(x, warc.Gap))


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        if k == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if k == "card":
            return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
        return k != "phone" or 9 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, t or "") if ok(k, m[0])]


PRIVATE = [
    (1, "a@b.c.d@e.f x@y.z_d@q.r.s 1.2.3.4.5 256.1.1.1 001.2.3.255 4111 1111-1111 1111, 4111111111111111  5 +1 (988) 555-2485.  +12 345  67 x@y"), (2, None), (3, ""), (4, "😀 é a@b.cd 4041894974608795\n+33 1 23 45 67 89  41"),
    (5, "1 " * 9000 + "4111111111111111"), (6, "x" * 50000 + "@" + "a.b" * 3), (7, " 41111111 1111 1111 "), (None, "a@b.cd"), (8, "a@b.cd"), (8, "a@b.cd"),
]


def test_pii_base(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in PRIVATE], "doc_id long, text string, __row int, kind string")
    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(df).collect())
    want = collections.Counter()
    for k, t in PRIVATE:
        b = base_spans(t)
        n = collections.Counter(x[0] for x in b)
        want[k, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{a}:{s}:{e}" for a, s, e in b).encode()).hexdigest()] += 1
    assert got == want
    assert pii.find(df.limit(0)).count() == 0
    clean = {(r.doc_id, r.text) for r in pii.redact(df).collect()}
    assert (8, "<EMAIL>") in clean and (2, None) in clean and (4, "😀 é <EMAIL> <CARD>\n<PHONE>") in clean
    assert pii.redact(df).columns == df.columns


def identifiers():
    """Known identifiers, unknown ones in their contexts, and what must stay."""
    key = [f"AKIA{chr(65 + i % 26)}BCDEFGHIJ2345X{chr(65 + i // 26)}" for i in range(48)]
    rows = [(50 + i, f"my key id: {key[i]} set, mail=user{i}@ex.com, card 4111 1111 1111 1111 of user") for i in range(48)]
    new = [f"Q{chr(65 + i)}7731ZZ-K{i}" for i in range(3)]
    rows += [(i, f"say the key id:\n{new[i]}  set and ip 10.0.0.{i} ok") for i in range(3)]
    rows += [(20, f"here, in another place: \ue002{new[0]}, {new[0]}x and again ({new[0]})"), (21, "mail=nobody.at.home, mail='x@y.zz'"), (22, "page nr: QA7731ZZ-K9 set")]
    rows += [(23, "card 4111111111111112 now"), (24, "card of user and card of ip"), (25, None), (26, ""), (20, None), (None, f"key id: {new[1]}")]
    found = {k: [("secret", key[k - 50])] for k in range(50, 98)} | {i: [("secret", new[i])] for i in range(3)}
    return rows, found | {20: [("secret", new[0])] * 2, 21: [("email", "nobody.at.home")], None: [("secret", new[1])]}


def test_pii_bootstrap(spark):
    rows, want = identifiers()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, value int").repartition(3)
    seen = []
    for r in pii.find(df).collect():
        for text in [t for k, t in rows if k == r.doc_id and (t or "") and len(t) >= max([int(x.split(":")[2]) for x in r.spans.split(",") if x], default=0)][:1]:
            got = [(k, text[int(s) : int(e)]) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
            base = [(k, text[s:e]) for k, s, e in base_spans(text)]
            assert [x for x in got if x in base] == base
            more = [x for x in got if x not in base]
            assert more == want.get(r.doc_id, []) or (r.doc_id == 20 and not r.spans)
            seen += more
    assert sorted(seen) == sorted(x for v in want.values() for x in v)
    clean = {(r.doc_id, r.text) for r in pii.redact(df).collect()}
    assert (1, "say the key id:\n<SECRET>  set and ip <IP> ok") in clean and (24, "card of user and card of ip") in clean and (25, None) in clean
    assert (20, f"here, in another place: \ue002<SECRET>, QA7731ZZ-K0x and again (<SECRET>)") in clean


def test_pii_scores_by_brute_force(spark):
    """The graph's scores on random edges, against dictionaries."""
    rng = random.Random(3)
    edges = sorted({(f"{rng.choice('LS')}:{rng.randrange(9)}", f"v{rng.randrange(40)}") for _ in range(150)})
    seed = {v: rng.choice(["email", None]) for _, v in edges}
    df = spark.createDataFrame([(p, v, seed[v], hash(v) % pii.SALT) for p, v in edges], "pattern string, value string, seed string, salt int")
    patterns, values = pii._score(df)
    size = collections.Counter(p for p, _ in edges)
    weight = {p: np.log2(n + 1) if p[0] == "L" else 1.0 for p, n in size.items()}
    p = {q: sum(seed[v] is not None for x, v in edges if x == q) / (size[q] + 2) for q in size}
    score = {v: sum(p[q] * weight[q] for q, x in edges if x == v) / sum(weight[q] for q, x in edges if x == v) for v in seed}
    assert all(abs(r.score - score[r.value]) < 1e-5 for r in values.collect()) and values.count() == len(seed)
    assert all(abs(r.p - p[r.pattern]) < 1e-9 for r in patterns.collect())


def test_pii_leaves_common_words(spark):
    """Words that now and then follow a phone number are no identifiers, however rare other words are there."""
    rows = [(i, f"call +1 (555) 555-{1000 + i} 10.0.{i}.7 today") for i in range(60)] + [(100 + i, f"call +1 (555) 555-{2000 + i} the rest of the day") for i in range(9)]
    rows += [(200 + i, "and the rest is the same") for i in range(20)]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    base = {k: ",".join(f"{a}:{s}:{e}" for a, s, e in base_spans(t)) for k, t in rows}  # an ip right after a phone number hides the latter
    assert {r.doc_id: r.spans for r in got} == base and base[0].startswith("ip") and base[100].startswith("phone")


def test_pieces(docs, empty):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(docs, model, seed=3).cache()
    assert rows.count() == len(TEXTS) and rows.where("not lossless").count() == 0
    back = collections.Counter((r.doc_id, r.text) for r in pieces.decode(rows, model).collect())
    assert back == collections.Counter((k, t or "") for k, t in TEXTS)
    again = pieces.encode(docs.repartition(1), model, seed=3, ids=False)
    assert sorted(map(str, rows.select("doc_id", "ids_crc32").collect())) == sorted(map(str, again.select("doc_id", "ids_crc32").collect()))
    other = pieces.encode(docs, model, seed=4, ids=False)
    assert rows.where("doc_id = 6").first().ids_crc32 != other.where("doc_id = 6").first().ids_crc32
    assert pieces.encode(empty, model).count() == 0


def test_pieces_do_not_depend_on_the_cache(monkeypatch):
    import pyarrow as pa

    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdeéß漢字 ", k=rng.randint(1, 9))) for _ in range(60)) for _ in range(40)] + ["漢" * 3000, "x" * 4000]
    keys = np.arange(len(texts))
    warm = pieces.Sampler(path)
    warm.encode(pa.array(texts[::-1]), keys, 9)
    ids, count = warm.encode(pa.array(texts), keys, 1)
    for i in range(len(texts)):
        one, _ = pieces.Sampler(path).encode(pa.array(texts[i : i + 1]), keys[i : i + 1], 1) if i % 9 == 0 else (ids[count[:i].sum() : count[: i + 1].sum()], 0)
        assert one.tolist() == ids[count[:i].sum() : count[: i + 1].sum()].tolist()
    monkeypatch.setattr(pieces, "CACHE", 50)
    assert pieces.Sampler(path).encode(pa.array(texts), keys, 1)[0].tolist() == ids.tolist()


def test_piece_distribution():
    import pyarrow as pa

    s = pieces.Sampler(public_tokenizers.path("piece_bpe_32k.model"))
    ids, count = s.encode(pa.array(["there"] * 20000), np.arange(20000), 1)
    at = np.cumsum(count) - count
    seen = collections.Counter(tuple(ids[a : a + c]) for a, c in zip(at, count, strict=True))

    def paths(t):
        if not t:
            yield (), 0.0
        for j in range(1, len(t) + 1):
            if t[:j] in s.piece:
                for rest, p in paths(t[j:]):
                    yield (s.piece[t[:j]][0], *rest), s.piece[t[:j]][1] + p

    mass = {k: np.exp(p) for k, p in paths("▁there")}
    total = sum(mass.values())
    assert all(abs(seen[k] / 20000 - m / total) < 0.012 for k, m in mass.items())

