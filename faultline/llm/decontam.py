"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a run of ``window`` words of a benchmark item (an item of fewer words is one pattern
of its own length). Patterns of one length m make a table: the shift of a block of two words says
how far a search position may move before any pattern could end there; a block of shift 0 ends a
pattern, and the bucket of its hash, together with that of the first block (the prefix), lists the
patterns to compare word for word. Texts are cut into runs of words that overlap by m - 1 words, and all
runs of a slice move at once, so the search is vectorised without losing the skips.

Patterns are made, and their repeats merged, by Spark, and stand in block files of about ``BLOCK`` patterns
in the shared folder, so a benchmark of any size passes neither the driver nor a broadcast. A task reads
one table after the other for a group of slices; a worker keeps up to ``KEPT`` patterns for later tasks.

Nulls have no words, nor do empty texts; a null item_id hits words but is not listed; repeated rows each
get their own result, repeated items are one; very long texts are read whole, cut in runs; an empty
benchmark leaves every text clean; columns of other names, clashing or not, are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import fresh_dir, slices, tidy, written
from faultline.llm.textvec import TO_WORDS, Words, mix64

_U64 = np.uint64
#: Patterns in a table, patterns in the tables that a worker keeps, and slices that meet the tables together where it cannot keep all.
BLOCK, KEPT, GROUP = 200_000, 400_000, 16
#: Words of a run that moves as one.
RUN = 192
SCHEMA = "n_words long, n_hit long, items array<string>"


def windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Distinct patterns: size, pattern (words joined by a space) and the items that have it."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, patterns, items = [], [], []
            for name, value in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                w = (value or "").encode().translate(TO_WORDS).split()
                size = min(window, len(w))
                found = {b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
                sizes += [size] * len(found)
                patterns += found
                items += [name] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(patterns, pa.binary()), pa.array(items, pa.string())], names=["size", "pattern", "item"])

    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(tidy(cut_up), "size int, pattern binary, item string").groupBy("size", "pattern").agg(F.collect_set("item").alias("items"))


class Table:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, size: int, patterns: dict[bytes, list[str]]):
        self.size, self.block = size, min(2, size)
        self.items, self.bytes = list(patterns.values()), list(patterns)
        words = Words(pa.array([p.decode("utf-8", "surrogateescape") for p in self.bytes], pa.large_string())).hash.reshape(-1, size)
        blocks = self.hashes(words.ravel()).reshape(-1)
        at = np.arange(len(words))[:, None] * size + np.arange(size - self.block + 1)[None, :]
        each = blocks[at]
        self.bits = max(12, min(24, int(each.size * 64 - 1).bit_length()))
        self.shift = np.full(1 << self.bits, size - self.block + 1, dtype=np.uint8 if size < 250 else np.int32)
        for j in range(size - self.block + 1):
            np.minimum.at(self.shift, self.slot(each[:, j]), size - self.block - j)
        bucket = self.bucket(each[:, -1], each[:, 0])
        self.order = np.argsort(bucket, kind="stable")
        self.buckets, self.words = bucket[self.order], words

    def hashes(self, words: np.ndarray) -> np.ndarray:
        """Of the block that begins at each word."""
        if self.block == 1:
            return words
        out = np.zeros_like(words)
        out[:-1] = words[:-1] * _U64(0xC2B2AE3D27D4EB4F) + words[1:]
        return mix64(out)

    @staticmethod
    def bucket(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return last * _U64(0x9E3779B97F4A7C15) + first

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U64(64 - self.bits)).astype(np.int64)

    def search(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of each occurrence in the texts of ``w``."""
        m, b, count = self.size, self.block, np.diff(w.first)
        if not len(w.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = self.hashes(w.hash)
        runs = np.maximum(0, -(-(count - m + 1) // RUN))
        row = np.repeat(np.arange(len(count)), runs)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
        begin = w.first[:-1][row] + nth * RUN
        pos = begin + m - b  # where the window's last block begins
        stop = np.minimum(begin + RUN, w.first[1:][row] - m + 1) + m - b
        starts, which = [], []
        while len(pos):
            here = blocks[pos]
            step = self.shift[self.slot(here)].astype(np.int64)
            hit = np.flatnonzero(step == 0)
            if len(hit):
                key = self.bucket(here[hit], blocks[pos[hit] - (m - b)])
                lo, hi = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
                many = hi - lo
                cand = np.repeat(pos[hit], many) - (m - b)
                pat = self.order[np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
                if len(cand):
                    same = (w.hash[cand[:, None] + np.arange(m)[None, :]] == self.words[pat]).all(axis=1)
                    for c, p in zip(cand[same].tolist(), pat[same].tolist(), strict=True):
                        if w.text(c, c + m) == self.bytes[p]:
                            starts.append(c)
                            which.append(p)
            pos = pos + np.maximum(step, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        return np.array(starts, dtype=np.int64), np.array(which, dtype=np.int64)


class Hits:
    """Words hit and items found in a slice, over several tables."""

    def __init__(self, texts: pa.Array):
        self.words = Words(texts)
        self.cover = np.zeros(len(self.words.hash) + 1, dtype=np.int64)
        self.items: list[set[str]] = [set() for _ in range(len(texts))]

    def add(self, t: Table) -> None:
        at, which = t.search(self.words)
        np.add.at(self.cover, at, 1)
        np.add.at(self.cover, at + t.size, -1)
        for row, p in set(zip(self.words.doc[at].tolist(), which.tolist(), strict=True)):
            self.items[row].update(t.items[p])

    def columns(self) -> list[pa.Array]:
        first = self.words.first
        total = np.concatenate([[0], np.cumsum(np.cumsum(self.cover)[:-1] > 0)])
        return [pa.array(np.diff(first), pa.int64()), pa.array(total[first[1:]] - total[first[:-1]], pa.int64()), pa.array([sorted(x) for x in self.items], pa.list_(pa.string()))]


_TABLES: dict[str, Table] = {}


def _table(path: str, size: int, block: int) -> Table | None:
    """The table of a block file; a worker keeps the last ones."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    name = f"{path}/size={size}/block={block}"
    if name not in _TABLES:
        system, at = fs.FileSystem.from_uri(name)
        if system.get_file_info(at).type == fs.FileType.NotFound:  # no pattern fell into this block
            return None
        files = [f.path for f in system.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
        read = pa.concat_tables([pq.ParquetFile(system.open_input_file(f)).read() for f in sorted(files)])
        made = Table(size, dict(zip(read.column("pattern").to_pylist(), read.column("items").to_pylist(), strict=True)))
        if sum(len(t.items) for t in _TABLES.values()) + len(made.items) > KEPT:
            _TABLES.clear()
        _TABLES[name] = made
    return _TABLES[name]


def find(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``documents``: ``key``, the columns ``keep``, n_words, n_hit and items (sorted as strings)."""
    patterns = written(windows(benchmark, item, item_text, window), "patterns")
    counts = sorted((r["size"], r["count"]) for r in patterns.groupBy("size").count().collect())  # at most ``window`` rows
    path = fresh_dir(documents.sparkSession, "tables")
    blocks = F.coalesce(*(F.when(F.col("size") == size, n // BLOCK + 1) for size, n in counts), F.lit(1))
    patterns.withColumn("block", F.pmod(F.xxhash64("pattern"), blocks)).repartition("size", "block").write.partitionBy("size", "block").parquet(path)
    names = [(size, block) for size, n in counts for block in range(n // BLOCK + 1)]
    group = 1 if sum(n for _, n in counts) <= KEPT else GROUP
    columns = list(dict.fromkeys([key, *keep]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, Hits]] = []

        def done() -> Iterator[pa.RecordBatch]:
            for size, block in names:
                t = _table(path, size, block)
                for _, hits in held if t else []:
                    hits.add(t)
            for batch, hits in held:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *hits.columns()], names=[*columns, "n_words", "n_hit", "items"])
            held.clear()

        for batch in slices(batches, "__text"):
            held.append((batch, Hits(batch.column("__text"))))
            if len(held) == group:
                yield from done()
        yield from done()

    read = documents.select(*columns, documents[text].cast("string").alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(tidy(scan), f"{kept}, {SCHEMA}")
