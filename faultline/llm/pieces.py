"""Sampled SentencePiece segmentations: forward filtering and backward sampling over the piece lattice.

A model file gives the pieces; a piece's log-probability is that of Zipf's law at its rank, so that
no tokenizer is trained. A text gets a space before it, spaces become U+2581, and the lattice has an
edge for every piece that is a substring, and one of byte pieces for every character that is no piece
(a literal U+2581 among them, so decoding stays lossless). Where two neighbouring characters stand side
by side in no piece, the lattice splits; the parts repeat, and the forward pass is done once for each
distinct part of a slice (kept in a bounded cache). Backward sampling draws, from the
end of every part at once, the edge that ends there with its posterior probability; the random number
is a hash of the seed, the row's key, and the part's and the step's number in the row. Probabilities are
whole numbers of ``1 / 2^BITS``, summed within a state alone, so results do not depend on partitions,
batches or the cache, and executors that are lost change nothing.

Nulls are empty texts and have no pieces; a null key draws as key 0; rows of one key and text have
one segmentation; an empty table gives an empty result; other columns than those kept are not read. Keys
are whole numbers (a text that is no number fails, as a cast does). A very long text is a slice of its own;
where its script gives no place to split it, its part is one long lattice, whose states are linear in it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import slices, tidy
from faultline.llm.textvec import _powers, buffers, mix64

_U64 = np.uint64
#: Distinct parts that a sampler keeps, and edges (16 bytes each).
CACHE, EDGES = 120_000, 2_000_000
#: Parts of one forward pass.
PASS = 6_000
#: Log-probability of a character as bytes.
BYTE_SCORE = -20.0
#: Low bits of a hash that choose its mark, high ones that choose where to look for it.
MARKS, BUCKET = 18, 13
LOW = _U64((1 << MARKS) - 1)
#: Bits of a probability; a state's number stands above them.
BITS = 40


def _order(values: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0, by 16 bits at a time: numpy has a radix sort for those."""
    order, top = None, int(values.max(initial=0))
    for shift in range(0, max(top.bit_length(), 1), 16):
        digit = (values >> shift).astype(np.uint16)
        order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return order


class Sampler:
    """Encoder and decoder for one model; ``theta`` 1 samples the posterior, more comes nearer the best segmentation."""

    def __init__(self, path: str, theta: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte = {}
        normal = []
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                normal.append((-model.get_score(i), i, piece))
                self.raw[i] = piece.replace("▁", " ").encode()
        if len(self.byte) < 256:
            raise ValueError("the model has no byte pieces")
        #: Two neighbouring ASCII characters that no piece has in it: the lattice splits between them.
        self.apart = np.zeros((256, 256), dtype=bool)
        self.apart[:128, :128] = True
        for _, _, p in normal:
            raw = p.replace("▁", " ").encode()
            for a, b in zip(raw, raw[1:], strict=False):
                self.apart[a, b] = False
        total = math.log(sum(1 / (r + 2) for r in range(len(normal))))
        self.piece = {p: (i, theta * (-math.log(rank + 2) - total)) for rank, (_, i, p) in enumerate(sorted(normal))}
        self.longest = max(map(len, self.piece))
        #: By length in characters: sorted hashes (and where each bucket of them begins), ids and scores of pieces, and a map of the hashes' low bits: 1 where a piece is, 2 where a longer piece begins so.
        self.tables = {}
        for length in range(1, self.longest + 1):
            some = [(p, *v) for p, v in self.piece.items() if len(p) == length]
            marks = np.zeros(1 << MARKS, np.uint8)
            h = self._of([x[0] for x in some], length)
            marks[(h & LOW).astype(np.int64)] = 1
            marks[(self._of(sorted({p[:length] for p in self.piece if len(p) > length}), length) & LOW).astype(np.int64)] |= 2
            order = np.argsort(h)
            known = np.append(h[order], _U64(2**64 - 1))  # an end to every search
            first = np.searchsorted(known, np.arange(1 << BUCKET, dtype=_U64) << _U64(64 - BUCKET))
            self.tables[length] = known, first, np.array([x[1] for x in some], np.int32)[order], np.array([x[2] for x in some], float)[order], marks
        size = np.fromiter(map(len, self.raw), np.int64, n)
        self.raw_size, self.raw_start = size, np.cumsum(size) - size
        self.raw_pool = np.frombuffer(b"".join(self.raw), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        #: Last edge of each part; by edge, in the order of the states where they end: probability of the edges
        #: of its state before it, last edge of the state that it comes from (-1: the part's first), and the
        #: piece (a character's bytes: minus its code point, minus 1).
        self._last = np.zeros(1 << 12, np.int32)
        self._low, self._before, self._id = np.zeros(1 << 16, _U64), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.parts = self.edges = 0

    def _append(self, names: tuple[str, ...], used: int, values: tuple[np.ndarray, ...]) -> int:
        """Write values behind the used places of equally long arrays, which double when they are full."""
        end = used + len(values[0])
        for name, value in zip(names, values, strict=True):
            held = getattr(self, name)
            if end > len(held):
                more = np.zeros(max(end, 2 * len(held)), held.dtype)
                more[:used] = held[:used]
                setattr(self, name, held := more)
            held[used:end] = value
        return end

    @staticmethod
    def _sums(chars: np.ndarray) -> np.ndarray:
        power = _powers(len(chars) + 1)[0]
        return np.concatenate([np.zeros(1, _U64), np.cumsum(mix64(chars.astype(_U64) + _U64(77)) * power[: len(chars)], dtype=_U64)])

    @staticmethod
    def _hashes(sums: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
        return mix64((sums[start + length] - sums[start]) * _powers(len(sums))[1][start])

    def _of(self, pieces: list[str], length: int) -> np.ndarray:
        """Hashes of pieces of one length."""
        return self._hashes(self._sums(np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)), np.arange(len(pieces)) * length, length)

    def _forward(self, parts: list[str]) -> None:
        """Add parts: posterior probabilities of the edges into each state, from the forward sums."""
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        part = np.repeat(np.arange(len(parts)), size)
        begin = np.cumsum(size) - size
        left = size[part] - (np.arange(len(chars)) - begin[part])  # characters from here to the part's end
        seen = np.where(chars == 32, 0x2581, np.where(chars == 0x2581, 0x110000, chars)).astype(np.uint32)
        sums = self._sums(seen)
        start, length, ids, score = [], [], [], []
        bare = np.ones(len(chars), dtype=bool)
        on = np.arange(len(chars))  # where a piece of this length or more may begin
        for n, (known, first, piece, value, marks) in self.tables.items():
            h = self._hashes(sums, on, n)
            mark = marks[(h & LOW).astype(np.int64)]
            some = np.flatnonzero(mark & 1)
            h = h[some]
            place = first[(h >> _U64(64 - BUCKET)).astype(np.int64)]
            less = np.flatnonzero(known[place] < h)
            while len(less):  # few: a bucket has about one hash
                place[less] += 1
                less = less[known[place[less]] < h[less]]
            same = known[place] == h
            at, place = on[some[same]], place[same]
            on = on[mark > 1]
            on = on[left[on] > n]
            if n == 1:
                bare[at] = False
            start.append(at)
            length.append(np.full(len(at), n))
            ids.append(piece[place])
            score.append(value[place])
        at = np.flatnonzero(bare)
        start.append(at)
        length.append(np.ones(len(at), np.int64))
        ids.append(-chars[at].astype(np.int32) - 1)
        score.append(np.full(len(at), BYTE_SCORE))
        start, length, ids, score = (np.concatenate(x) for x in (start, length, ids, score))
        before = start + part[start]  # a part has one state more than characters
        state = before + length
        order = _order(state)
        before, state, ids, score = before[order], state[order], ids[order].astype(np.int32), score[order]
        step = state - (begin + np.arange(len(parts)))[part[start[order]]]
        by_step = _order(step)
        bounds = np.searchsorted(step[by_step], np.arange(1, int(size.max()) + 2))
        alpha = np.zeros(len(chars) + len(parts))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            e = by_step[a:b]
            s = state[e]
            new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            value = alpha[before[e]] + score[e]
            top = np.maximum.reduceat(value, new)
            alpha[s[new]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(new, len(e))))), new))
        whole = np.floor(np.exp(alpha[before] + score - alpha[state]) * (1 << BITS)).astype(_U64)
        new = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        run = np.cumsum(whole, dtype=_U64) - whole  # whole numbers: what other states add goes away exactly
        low = np.minimum(run - np.repeat(run[new], np.diff(np.append(new, len(state)))), _U64(1 << BITS))
        ending = np.full(len(alpha), -1, np.int32)
        ending[state[new]] = np.append(new[1:], len(state)) - 1 + self.edges
        self.edges = self._append(("_low", "_before", "_id"), self.edges, (low, ending[before], ids))
        self.parts = self._append(("_last",), self.parts, (ending[begin + np.arange(len(parts)) + size],))

    def _expanded(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of edges, one after the other, and how many each has."""
        ids = self._id[edges]
        if not len(ids) or ids.min() >= 0:
            return ids, np.ones(len(ids), np.int64)
        points, which = np.unique(ids, return_inverse=True)
        raw = [[int(p)] if p >= 0 else [self.byte[b] for b in chr(-int(p) - 1).encode()] for p in points]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        pool = np.array([i for x in raw for i in x], np.int32)
        n = size[which]
        return pool[np.repeat((np.cumsum(size) - size)[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n

    def _codes(self, parts: list[str]) -> np.ndarray:
        if len(self.known) + len(parts) > CACHE or self.edges > EDGES:
            self._clear()
        new = [p for p in parts if p not in self.known]
        if new:
            new.sort(key=len)  # few passes have many steps
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            for i in range(0, len(new), PASS):
                self._forward(new[i : i + PASS])
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def encode(self, texts: pa.Array, keys: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        if texts.null_count:
            texts = texts.fill_null("")
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)))
        data, off = buffers(spaced)
        n = len(off) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = self.apart[data[:-1], data[1:]]
        cut[off[:-1][off[:-1] < len(data)]] = True
        start = np.flatnonzero(cut)
        parts = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        code = self._codes(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
        row = np.searchsorted(off, start, side="right") - 1
        nth = np.arange(len(start)) - np.searchsorted(row, row)
        base = mix64(mix64(keys.astype(np.int64).view(_U64) + _U64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))[row] + nth.astype(_U64) * _U64(0xD1342543DE82EF95))
        low, before = self._low, self._before
        who = _order(code)  # neighbours read the same edges
        at = self._last[code[who]]
        base = base[who]
        count = np.zeros(len(start), np.int64)
        chosen, owner = [], []
        while len(who):
            u = mix64(base + _U64(len(chosen) + 1)) >> _U64(64 - BITS)
            left = np.flatnonzero(low[at] > u)
            while len(left):  # the last edge of the state that begins at most at u
                at[left] -= 1
                left = left[low[at[left]] > u[left]]
            chosen.append(at)
            owner.append(who)
            at = before[at]
            on = at >= 0
            count[who[~on]] = len(chosen)
            who, at, base = who[on], at[on], base[on]
        ends = np.cumsum(count)
        edges = np.empty(int(ends[-1]), np.int32)
        for t, (e, w) in enumerate(zip(chosen, owner, strict=True)):
            edges[ends[w] - 1 - t] = e
        ids, size = self._expanded(edges)
        return ids, np.bincount(np.repeat(row, count), size, n).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all rows, and where each row ends; the space before a text is gone."""
        size = self.raw_size[ids]
        total = int(size.sum())
        begin = np.cumsum(size) - size
        data = self.raw_pool[np.repeat(self.raw_start[ids] - begin, size) + np.arange(total)]
        last = np.cumsum(count)
        ends = np.concatenate([[0], np.cumsum(size)])[last]
        firsts = np.concatenate([[0], ends[:-1]])[count > 0] if len(ends) else np.zeros(0, np.int64)
        keep = np.ones(total, dtype=bool)
        keep[firsts] = False
        return data[keep], ends - np.cumsum(count > 0)


_SAMPLERS: dict[tuple[str, float], Sampler] = {}


def sampler(path: str, theta: float) -> Sampler:
    """The worker process's sampler, with no parts yet."""
    if (path, theta) not in _SAMPLERS:
        _SAMPLERS.clear()
        _SAMPLERS[path, theta] = Sampler(path, theta)
    _SAMPLERS[path, theta]._clear()
    return _SAMPLERS[path, theta]


def encode(documents: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0, theta: float = 1.0, keep: tuple[str, ...] = ("doc_id",), ids: bool = True) -> DataFrame:
    """Per row: the columns ``keep``, ids (if wanted), n_pieces, ids_crc32 (ids as little-endian 32 bits) and lossless (decoding them gave the text)."""
    read = documents.select(*keep, F.col(key).cast("long").alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model, theta)
        for batch in slices(batches, "__text", 1 << 19):
            texts = batch.column("__text")
            got, count = s.encode(texts, batch.column("__key").fill_null(0).to_numpy(zero_copy_only=False), seed)
            back, ends = s.decode(got, count)
            data, off = buffers(texts)
            if len(back) == len(data) and (ends == off[1:]).all() and (back == data).all():
                same = np.ones(len(texts), dtype=bool)
            else:
                lo = np.concatenate([[0], ends[:-1]])
                same = np.array([back[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(lo, ends, off[:-1], off[1:], strict=True)], dtype=bool)
            raw, last = memoryview(got.astype("<u4").tobytes()), np.cumsum(count)
            crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(last.tolist(), count.tolist(), strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last]), pa.int32()), pa.array(got.astype(np.int32)))] if ids else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *lists, pa.array(count), pa.array(crc, pa.int64()), pa.array(same)], names=[*keep, *["ids"] * ids, "n_pieces", "ids_crc32", "lossless"])
        s._clear()

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in read.schema.fields[: len(keep)])
    return read.mapInArrow(tidy(apply), f"{kept}{'ids array<int>, ' * ids}n_pieces long, ids_crc32 long, lossless boolean")


def decode(encoded: DataFrame, model: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the columns ``keep`` and the text of its ids (null ids: an empty text)."""
    read = encoded.select(*keep, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("__ids"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model, 1.0)
        for batch in batches:
            lists = batch.column("__ids")
            count = lists.value_lengths().to_numpy().astype(np.int64)
            data, ends = s.decode(lists.flatten().to_numpy(), count)
            raw, lo = data.tobytes(), np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(lo.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in read.schema.fields[: len(keep)])
    return read.mapInArrow(tidy(apply), f"{kept}text string")
