"""Chroma audio fingerprints and the alignment of recordings by them.

Samples become frames of energy in the twelve pitch classes (Hann window, FFT, bins summed by pitch,
each frame of unit length). Sixteen filters look at windows of ``SPAN`` frames: each compares the sums
of two sets of rectangles, read from an integral image, as the logarithm of their ratio; three
thresholds make two Gray-coded bits of it, and the sixteen pairs are packed into one integer. A
recording's fingerprint is one integer for each window.

Search: recordings of equal fingerprints are one class, and classes meet classes; each row then gets the
matches of its class. The queries' integers, shortened to ``KEY_BITS``, are an inverted index. A
recording's integers look up (query, place); a histogram over place differences gives the offsets, and
wherever the overlap is long enough the share of differing bits there decides. All offsets with a vote are
tried. Queries stand in block files of about ``BLOCK`` classes in the shared folder; a task reads one after
the other for a group of its recordings, so nothing goes through the driver or is broadcast, and every
class meets every query.

Null or unreadable audio, and audio shorter than a window, has an empty fingerprint and matches
nothing; repeated rows each get their own result; a null key is no query; an empty table gives an
empty result; other columns are not read. Keys are whole numbers (a text that is no number fails, as a cast
does). A long recording is a row of its own in the search; equal ones are searched once.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import fresh_dir, tidy, written

FRAME, HOP, SPAN = 1024, 256, 12
KEY_BITS = 16
#: Classes of queries in a block, recordings that meet the blocks together, and look-ups of one step.
BLOCK, GROUP, STEP = 4096, 8192, 1 << 22
MOST_BER = 0.28
LEAST_OVERLAP = 24


def _filters() -> list[tuple[int, int, int, int, int]]:
    """Sixteen filters (kind, first class, classes, first frame, frames), by rule; kinds as in :func:`_respond`."""
    out = []
    for i in range(16):
        kind, height = i % 4, (3, 4, 6, 2)[i // 4]
        width = (12, 8, 6, 4)[(i + i // 4) % 4]
        first = (5 * i) % (12 - height + 1)
        out.append((kind, first, height, (SPAN - width) // 2, width))
    return out


FILTERS = _filters()
THRESHOLDS = (-0.35, 0.0, 0.35)
_BINS: dict[int, np.ndarray] = {}


def wav(content: bytes | None) -> tuple[int, np.ndarray] | None:
    """Rate and mono samples of a 16-bit WAV file."""
    try:
        with wave.open(io.BytesIO(content or b"")) as f:
            if f.getsampwidth() != 2:
                return None
            x = np.frombuffer(f.readframes(f.getnframes()), "<i2").astype(np.float32) / 32768
            return f.getframerate(), x.reshape(-1, f.getnchannels()).mean(axis=1)
    except (wave.Error, EOFError, ValueError):
        return None


def to_wav(rate: int, samples: np.ndarray) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def chroma(rate: int, samples: np.ndarray) -> np.ndarray:
    """Frames x 12, of unit length (silent frames are 0)."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12), np.float32)
    frames = np.lib.stride_tricks.as_strided(samples, (n, FRAME), (samples.strides[0] * HOP, samples.strides[0])) * np.hanning(FRAME).astype(samples.dtype)
    energy = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    if rate not in _BINS:
        f = np.fft.rfftfreq(FRAME, 1 / rate)
        to = np.zeros((len(f), 12))
        for b in np.flatnonzero((f >= 55) & (f <= 4000)):  # a bin between two classes counts for both
            pitch = 12 * np.log2(f[b] / 440)
            low = int(np.floor(pitch))
            to[b, low % 12] += 1 - (pitch - low)
            to[b, (low + 1) % 12] += pitch - low
        _BINS[rate] = to
    c = energy @ _BINS[rate]
    norm = np.sqrt((c * c).sum(axis=1, keepdims=True))
    return np.divide(c, norm, out=np.zeros_like(c), where=norm > 1e-6)


def _respond(image: np.ndarray, at: np.ndarray, kind: int, y: int, h: int, x: int, w: int) -> np.ndarray:
    """Log ratio of two rectangle sums: halves in time, halves in pitch, middle against sides, or diagonal quarters."""
    area = lambda y0, y1, x0, x1: image[at + x1, y1] - image[at + x0, y1] - image[at + x1, y0] + image[at + x0, y0]
    hy, hx = y + max(1, h // 2), x + w // 2
    if kind == 0:
        a, b = area(y, y + h, x, hx), area(y, y + h, hx, x + w)
    elif kind == 1:
        a, b = area(y, hy, x, x + w), area(hy, y + h, x, x + w)
    elif kind == 2:
        third = w // 3 or 1
        a = area(y, y + h, x + third, x + w - third)
        b = area(y, y + h, x, x + w) - a
    else:
        a = area(y, hy, x, hx) + area(hy, y + h, hx, x + w)
        b = area(y, hy, hx, x + w) + area(hy, y + h, x, hx)
    return np.log((a + 0.05) / (b + 0.05))


def fingerprint(rate: int, samples: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each window of ``SPAN`` frames."""
    c = chroma(rate, samples)
    n = len(c) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(c) + 1, 13))
    image[1:, 1:] = c.cumsum(axis=0).cumsum(axis=1)
    at, out = np.arange(n), np.zeros(n, np.uint32)
    for f in FILTERS:
        level = np.searchsorted(THRESHOLDS, _respond(image, at, *f)).astype(np.uint32)
        out = out << np.uint32(2) | (level ^ level >> np.uint32(1))
    return out


def fingerprints(media: DataFrame, key: str, audio: str, decode: Callable[[object], tuple[int, np.ndarray] | None] = wav) -> DataFrame:
    """Per row: key and ``print``, array of integers. ``decode`` turns a value of the media column into rate and samples."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                prints = []
                for value in part.column("audio"):
                    found = decode(value.as_py())
                    prints.append(fingerprint(*found).astype(np.int64) if found else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(prints, pa.list_(pa.int64()))], names=["key", "print"])

    return media.select(F.col(key).cast("long").alias("key"), F.col(audio).alias("audio")).mapInArrow(tidy(apply), "key long, print array<long>")


class Index:
    """Inverted index of a block of queries: their numbers (any), and their fingerprints one after the other."""

    def __init__(self, keys: np.ndarray, pool: np.ndarray, size: np.ndarray):
        self.keys, self.pool = keys, pool.astype(np.uint32)
        self.begin, self.size = np.cumsum(size) - size, size
        query, place = np.repeat(np.arange(len(keys)), size), np.arange(len(self.pool)) - np.repeat(self.begin, size)
        code = self.pool >> np.uint32(32 - KEY_BITS)
        order = np.argsort(code, kind="stable")
        self.code, self.query, self.place = code[order], query[order], place[order]

    def search(self, pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, query, offset, votes, share of differing bits) of the rows' matches; a row's place + offset is the query's."""
        code = pool >> np.uint32(32 - KEY_BITS)
        lo, hi = np.searchsorted(self.code, code, "left"), np.searchsorted(self.code, code, "right")
        n = np.concatenate([[0], np.cumsum(hi - lo)])
        of = n[begin + size] - n[begin] if len(pool) else np.zeros(len(size), np.int64)
        ends = np.cumsum(of)
        first = 0
        while first < len(size):  # rows of at most STEP look-ups, or one row
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + STEP, side="right")))
            if ends[last - 1] > (ends[first - 1] if first else 0):
                yield from self._some(pool, begin, size, lo, hi, first, last)
            first = last

    def _some(self, pool: np.ndarray, begin: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int, int, int, float]]:
        a, b = begin[first], begin[last - 1] + size[last - 1]
        row = np.repeat(np.arange(first, last), size[first:last])
        place = np.arange(a, b) - begin[row]
        n = (hi - lo)[a:b]
        hit = np.repeat(lo[a:b], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        r, q, offset = np.repeat(row, n), self.query[hit], self.place[hit] - np.repeat(place, n)
        del hit
        (r, q, offset), votes = self._histogram(r, q, offset)
        skip = np.maximum(0, -offset)
        overlap = np.minimum(size[r] - skip, self.size[q] - (skip + offset))
        ok = np.flatnonzero(overlap >= np.minimum(LEAST_OVERLAP, np.minimum(size[r], self.size[q])))
        r, q, offset, votes, skip, overlap = (x[ok] for x in (r, q, offset, votes, skip, overlap))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        ends = np.cumsum(overlap)
        at = 0
        while at < len(r):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, side="right")))
            k = overlap[at:to]
            inner = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
            left = pool[np.repeat(begin[r[at:to]] + skip[at:to], k) + inner]
            left ^= self.pool[np.repeat(self.begin[q[at:to]] + skip[at:to] + offset[at:to], k) + inner]
            wrong = np.add.reduceat(np.bitwise_count(left).astype(np.int64), np.cumsum(k) - k) / (32 * k)
            for i in np.flatnonzero(wrong <= MOST_BER).tolist():
                pair, found = (int(r[at + i]), int(q[at + i])), (float(wrong[i]), int(offset[at + i]), int(votes[at + i]))
                if pair not in best or found < best[pair]:
                    best[pair] = found
            at = to
        for (row_, query_), (e, off_, v) in best.items():
            yield row_, query_, off_, v, e

    @staticmethod
    def _histogram(r: np.ndarray, q: np.ndarray, offset: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        span, n, low = int(np.abs(offset).max()) + 1, int(q.max()) + 1, int(r.min())
        code, votes = np.unique(((r - low) * n + q) * (2 * span) + offset + span, return_counts=True)
        rest, offset = code // (2 * span), code % (2 * span) - span
        return (rest // n + low, rest % n, offset), votes


_LAST: dict[str, Index] = {}


def _index(path: str, block: int) -> Index | None:
    """The index of a block file; a worker keeps the last one."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    name = f"{path}/block={block}"
    if name not in _LAST:
        system, at = fs.FileSystem.from_uri(name)
        _LAST.clear()
        if system.get_file_info(at).type == fs.FileType.NotFound:
            return None
        files = [f.path for f in system.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
        read = pa.concat_tables([pq.ParquetFile(system.open_input_file(f)).read() for f in files]).combine_chunks()
        lists = read.column("print").chunk(0)
        _LAST[name] = Index(read.column("class").to_numpy(), lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64))
    return _LAST[name]


MATCH = "array<struct<query:long,n:long,offset:int,votes:int,ber:double>>"


def search(prints: DataFrame, is_query: Column) -> DataFrame:
    """Per row of ``prints`` (key, print; stored): key, length, is_query, matches and n_matches.

    A match is a class of queries with equal fingerprints: its least key and number of rows, offset, votes
    and share of differing bits. A row's own class is a match if it has another query than the row itself;
    ``n_matches`` counts all query rows but the row itself.
    """
    rows = prints.select("key", F.coalesce("print", F.array().cast("array<bigint>")).alias("print"), (F.coalesce(is_query, F.lit(False)) & F.col("key").isNotNull()).alias("is_query"))
    groups = rows.groupBy("print").agg(F.min(F.when(F.col("is_query"), F.col("key"))).alias("query"), F.count_if("is_query").alias("n"))
    groups = written(groups.withColumn("class", F.monotonically_increasing_id()), "classes")
    queries = groups.where("n > 0")
    blocks = queries.count() // BLOCK + 1
    path = fresh_dir(prints.sparkSession, "queries")
    queries.select("class", "print", F.pmod(F.xxhash64("class"), F.lit(blocks)).alias("block")).repartition("block").write.partitionBy("block").parquet(path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                lists = part.column("print")
                pool, size = lists.flatten().to_numpy().astype(np.uint32), lists.value_lengths().to_numpy().astype(np.int64)
                out: list[tuple] = []
                for i in range(blocks):
                    index = _index(path, i)
                    if index is not None:
                        out += [(row, index.keys[q], off, votes, ber) for row, q, off, votes, ber in index.search(pool, np.cumsum(size) - size, size)]
                row, other, off, votes, ber = zip(*out, strict=True) if out else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("class").take(pa.array(row, pa.int64())), pa.array(other, pa.int64()), pa.array(off, pa.int32()), pa.array(votes, pa.int32()), pa.array(np.round(ber, 6), pa.float64())], names=["class", "other", "offset", "votes", "ber"]
                )

    links = groups.where(F.size("print") > 0).select("class", "print").mapInArrow(tidy(apply), "class long, other long, offset int, votes int, ber double")
    links = links.join(queries.select(F.col("class").alias("other"), "query", "n"), "other")
    found = links.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("query", "n", "offset", "votes", "ber"))).alias("matches"))
    classed = groups.select("print", F.col("class"), F.col("query").alias("own"), F.col("n").alias("own_n")).join(found, "class", "left")
    out = rows.join(classed, "print").withColumn("matches", F.coalesce("matches", F.array().cast(MATCH)))
    # the class of the row itself is no match if the row is its only query
    out = out.withColumn("matches", F.when(F.col("is_query") & (F.col("own_n") == 1), F.filter("matches", lambda m: m["query"] != F.col("own"))).otherwise(F.col("matches")))
    total = F.aggregate("matches", F.lit(0).cast("long"), lambda a, m: a + m["n"])
    return out.select("key", F.size("print").cast("long").alias("length"), "is_query", "matches", (total - F.when(F.col("is_query") & (F.col("own_n") > 1), 1).otherwise(0)).alias("n_matches"))


RATE, NOTE = 4000, 256


def tune(vector: list[float] | None) -> tuple[int, np.ndarray] | None:
    """A recording of a vector: one gliding tone for each number, an octave around 440 Hz."""
    if not vector:
        return None
    x = np.nan_to_num(np.array([v if v is not None else 0.0 for v in vector], np.float64))
    f = 440 * 2 ** np.tanh(2 * x)
    return RATE, np.sin(2 * np.pi * np.cumsum(np.repeat(f, NOTE)) / RATE).astype(np.float32)


def align(media: DataFrame, is_query: Column, key: str, audio: str, decode: Callable = wav) -> DataFrame:
    """Fingerprints of all rows, kept in the shared folder, searched for those of the queries (a condition on ``key``)."""
    return search(written(fingerprints(media, key, audio, decode), "prints"), is_query)
