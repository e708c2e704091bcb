"""Token ids as wavelet matrices: one compressed file for each shard.

Encoding. A byte-level tokenizer never joins what stands before a space to what follows it when
the space's next character is not white space, so texts are cut there and every distinct piece is
encoded once for a slice (and kept in a bounded cache, which when full keeps the pieces that came
again); ids of a text are the ids of its pieces. A
text that holds an added token (such as the end of text) literally is encoded whole instead, so such
tokens get the ids that the plain call gives them.

File. ``FLWM1`` and a length, a JSON header (count, bits, documents, sizes of the parts), then the
parts, each compressed with zstd: ids of the documents, their first tokens, and one bit-plane for
each bit of the ids from the highest down. In a plane, the ids stand in the order that the planes
above leave them in: stably, those with bit 0 first. Rank directories (ones before every 64th bit)
are made when a plane is opened; with them access, rank, select and counting take one step a plane.
The read back takes the first token of each shard from a running sum over the shards' counts, which
stay in the shared folder: the driver holds nothing of them.

Documents stand in ascending order of their key over all shards (rows of one key in the order of a
hash of the text); nulls are empty texts and have the end id alone; a null key sorts first; an empty
table gives no shard and no row; other columns are not read. Keys are whole numbers (a text that is
no number fails, as a cast does). Files have a name given by partition and number, and are moved into
place when whole, so a task that runs twice leaves one file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.shared import cut, fresh_dir, slices, tidy
from faultline.llm.textvec import buffers

MAGIC = b"FLWM1\n"
#: Tokens after which a shard is closed.
SHARD_TOKENS = 3_000_000
#: Pieces that an encoder keeps.
CACHE = 1_000_000
#: Ids that are put into order at a time.
STRETCH = 1 << 16
#: New pieces that are encoded as one text.
JOINED = 2000

#: Bytes that may begin white space (ASCII, then lead bytes of other white space).
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: ASCII letters and digits, and what ends a run of them whatever follows.
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[9, 10, 13, *range(33, 127)]] = True
_MARK &= ~_ALNUM


class Encoder:
    """Ids of whole texts, by a tokenizer of the tokenizers library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)  # of each id; the alphabet has a character for each byte
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.pool, self.sizes, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)
        self.used = 0

    def _add(self, pieces: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        at = len(self.known)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while at + len(pieces) > len(self.sizes):
            self.sizes, self.begin, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sizes, self.begin, self.again))
        self.pool[self.used : self.used + len(flat)] = flat
        self.sizes[at : at + len(pieces)] = size
        self.begin[at : at + len(pieces)] = self.used + np.cumsum(size) - size
        self.again[at : at + len(pieces)] = False
        self.used += len(flat)
        self.known = pa.concat_arrays([self.known, pieces])

    def _thin(self) -> None:
        """Keep the pieces that came again since they were added, or none if that is most of them."""
        keep = np.flatnonzero(self.again[: len(self.known)])
        known, pool, sizes, begin = self.known, self.pool, self.sizes, self.begin
        self._clear()
        if len(keep) <= CACHE // 2:
            size = sizes[keep]
            flat = pool[np.repeat(begin[keep] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
            self._add(known.take(pa.array(keep)), flat, size)

    def _codes(self, distinct: pa.Array) -> np.ndarray:
        """Places of distinct pieces among the known ones; new ones are encoded."""
        if len(self.known) + len(distinct) > CACHE:
            self._thin()
        code = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy().astype(np.int64)
        self.again[code[code >= 0]] = True
        new = np.flatnonzero(code < 0)
        if len(new):
            at = len(self.known)
            order = self._encode_new(distinct.take(pa.array(new)))
            code[new[order]] = np.arange(at, at + len(new))
        return code

    def _encode_new(self, column: pa.Array) -> np.ndarray:
        """Encodes pieces and adds them to the known ones; returns the order that they were added in.

        A piece that begins with a space before a visible character is cut off from whatever stands
        before it, so many such pieces make one text; the bytes of its ids tell where each ends.
        """
        new = column.to_numpy(zero_copy_only=False).tolist()
        data, off = buffers(column)
        size = np.diff(off)
        joins = (size > 1) & (data[off[:-1]] == 32) & ~_SPACE[data[np.minimum(off[:-1] + 1, len(data) - 1)]]
        led, rest = np.flatnonzero(joins), np.flatnonzero(~joins)
        texts = ["".join([new[j] for j in led[i : i + JOINED].tolist()]) for i in range(0, len(led), JOINED)]
        got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts + [new[j] for j in rest.tolist()], add_special_tokens=False)]
        joined = np.concatenate(got[: len(texts)]) if texts else np.zeros(0, np.uint32)
        last = np.searchsorted(np.cumsum(self.bytes[joined]), np.cumsum(size[led]))
        count = np.concatenate([np.diff(last + 1, prepend=0), [len(x) for x in got[len(texts) :]]]).astype(np.int64)
        order = np.concatenate([led, rest])
        self._add(column.take(pa.array(order)), np.concatenate([joined, *got[len(texts) :]]), count)
        return order

    def _holding(self, texts: pa.Array) -> pa.Array:
        """The rows whose texts hold an added token."""
        found = pa.array(np.zeros(len(texts), bool))
        raw = buffers(texts)[0].tobytes()
        for token in self.added:
            if token.encode() in raw:
                found = pc.or_(found, pc.fill_null(pc.match_substring(texts, token), False))
        return found

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; ``end`` follows each."""
        held = self._holding(texts)
        rows = np.flatnonzero(held.to_numpy(zero_copy_only=False))
        if not len(rows):
            return self._encode(texts, end)
        ids, count = self._encode(pc.if_else(held, pa.scalar("", texts.type), texts), end)
        parts = np.split(ids, np.cumsum(count)[:-1])
        tail = [] if end is None else [end]
        for i, e in zip(rows.tolist(), self.tokenizer.encode_batch_fast(texts.filter(held).to_pylist(), add_special_tokens=False), strict=True):
            parts[i] = np.array([*e.ids, *tail], np.uint32)
            count[i] = len(parts[i])
        return np.concatenate(parts), count

    def _encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens, by pieces."""
        data, off = buffers(texts)
        n = len(off) - 1
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 1:
            cut[:-2] = (data[:-1] == 32) & ~_SPACE[data[1:]]
            cut[off[1:] - 1] = False  # a text's last byte has no successor
            cut[1:-1] |= _ALNUM[data[:-1]] & _MARK[data[1:]]
        cut[off[:-1]] = True
        cut[-1] = False
        start = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        code = self._codes(pieces.dictionary)[pieces.indices.to_numpy()] if len(start) else np.zeros(0, np.int64)
        size = self.sizes[code]
        row = np.searchsorted(off, start, side="right") - 1
        count = np.bincount(row, weights=size, minlength=n).astype(np.int64)
        total = int(size.sum())
        step = np.ones(total, dtype=np.int64)  # places in the pool, as a running sum
        first = np.cumsum(size) - size
        begin = self.begin[code]
        full = size > 0
        step[first[full]] = np.diff(begin[full], prepend=0) - np.concatenate([[0], size[full][:-1] - 1])[: full.sum()]
        ids = self.pool[np.cumsum(step)]
        if end is None:
            return ids, count
        out = np.empty(total + n, dtype=np.uint32)
        last = np.cumsum(count + 1) - 1
        out[last] = end
        own = np.ones(total + n, dtype=bool)
        own[last] = False
        out[own] = ids
        return out, count + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder: tasks that follow one another share its pieces."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Stably, what stands where ``b`` is 0, then the rest; by stretches that a processor's cache holds."""
    out, i, j = np.empty_like(a), 0, len(b) - int(np.count_nonzero(b))
    for s in range(0, len(a), STRETCH):
        x, y = a[s : s + STRETCH], b[s : s + STRETCH]
        zero, one = np.flatnonzero(~y), np.flatnonzero(y)
        x.take(zero, out=out[i : i + len(zero)], mode="clip")
        x.take(one, out=out[j : j + len(one)], mode="clip")
        i, j = i + len(zero), j + len(one)
    return out


def together(a: np.ndarray, b: np.ndarray, bit: int) -> np.ndarray:
    """What ``apart`` took apart, with ``bit`` where ``b`` is 1."""
    out, i, j = np.empty_like(a), 0, len(b) - int(np.count_nonzero(b))
    for s in range(0, len(a), STRETCH):
        x, y = out[s : s + STRETCH], b[s : s + STRETCH]
        zero, one = np.flatnonzero(~y), np.flatnonzero(y)
        x[zero] = a[i : i + len(zero)]
        x[one] = a[j : j + len(one)] | a.dtype.type(bit)
        i, j = i + len(zero), j + len(one)
    return out


def pack(ids: np.ndarray, keys: np.ndarray, counts: np.ndarray, valid: np.ndarray) -> bytes:
    """A shard's file: ``keys`` (``valid``: not null) and token counts of its documents, and all ids."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    parts = [np.ascontiguousarray(keys, np.int64).tobytes(), np.packbits(valid).tobytes(), np.ascontiguousarray(counts, np.int64).tobytes()]
    for bit in range(bits - 1, -1, -1):
        b = (a >> a.dtype.type(bit) & a.dtype.type(1)).astype(bool)
        parts.append(np.packbits(b).tobytes())
        a = apart(a, b)
    press = zstandard.ZstdCompressor(level=1)
    packed = [press.compress(p) for p in parts]
    header = json.dumps({"tokens": len(ids), "bits": bits, "documents": len(keys), "parts": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *packed])


class Shard:
    """A shard's file, opened: its planes are unpacked when first used."""

    def __init__(self, file: bytes):
        if not file.startswith(MAGIC):
            raise ValueError("not a shard")
        size = int.from_bytes(file[6:10], "little")
        head = json.loads(file[10 : 10 + size])
        self.tokens, self.bits, self.documents = head["tokens"], head["bits"], head["documents"]
        ends = np.cumsum([10 + size, *head["parts"]]).tolist()
        part = [file[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.keys = np.frombuffer(zstandard.decompress(part[0]), np.int64)
        self.valid = np.unpackbits(np.frombuffer(zstandard.decompress(part[1]), np.uint8), count=self.documents).astype(bool)
        self.counts = np.frombuffer(zstandard.decompress(part[2]), np.int64)
        self._planes, self._rank = part[3:], {}

    def plane(self, p: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(zstandard.decompress(self._planes[p]), np.uint8), count=self.tokens).view(bool)

    def _directory(self, p: int) -> tuple[np.ndarray, np.ndarray, int]:
        if p not in self._rank:
            b = self.plane(p)
            ones = np.concatenate([[0], np.cumsum(np.add.reduceat(b, np.arange(0, len(b), 64), dtype=np.int64))]) if len(b) else np.zeros(1, np.int64)
            self._rank[p] = np.packbits(b), ones, int(len(b) - ones[-1])
        return self._rank[p]

    def _ones(self, p: int, i: int) -> int:
        """Ones of plane p before place i."""
        packed, ones, _ = self._directory(p)
        at = i // 64
        return int(ones[at]) + int(np.unpackbits(packed[at * 8 : at * 8 + 8], count=i - at * 64).sum() if i > at * 64 else 0)

    def access(self, i: int) -> int:
        out = 0
        for p in range(self.bits):
            one, zeros = self._ones(p, i), self._directory(p)[2]
            bit = self._ones(p, i + 1) - one
            out = out << 1 | bit
            i = zeros + one if bit else i - one
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for p in range(self.bits):
            a, b, zeros = self._ones(p, lo), self._ones(p, hi), self._directory(p)[2]
            lo, hi = (zeros + a, zeros + b) if token >> (self.bits - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` in places lo to before hi."""
        a, b = self._range(token, lo, self.tokens if hi is None else hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of occurrence ``k`` (from 0) of ``token``."""
        lo, hi = self._range(token, 0, self.tokens)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.bits - 1, -1, -1):
            zeros = self._directory(p)[2]
            one = i >= zeros
            want = i - zeros if one else i
            left, right = 0, self.tokens
            while left < right:  # the least place with want + 1 such bits before it
                mid = (left + right) // 2
                got = self._ones(p, mid + 1)
                left, right = (left, mid) if (got if one else mid + 1 - got) > want else (mid + 1, right)
            i = left
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def all(self) -> np.ndarray:
        """All ids: from the lowest plane up, places move back to where the plane above had them."""
        a = np.zeros(self.tokens, np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            a = together(a, self.plane(p), 1 << (self.bits - 1 - p))
        return a


def put(path: str, content: bytes) -> None:
    """Write a file whole: under another name first, then moved."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    part = f"{at}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        f.write(content)
    system.move(part, at)


def write(documents: DataFrame, tokenizer: str, path: str, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write shards below ``path``; returns shard (partition and number), documents and tokens of each."""
    from pyarrow import fs

    spark = documents.sparkSession
    system, at = fs.FileSystem.from_uri(path)
    system.create_dir(at)
    rows = documents.select(F.col(key).cast("long").alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    order = ["__key", "__hash"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("__hash", F.xxhash64("__text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, counts, keys, valid = [], [], [], []

        def close() -> pa.RecordBatch:
            nonlocal number
            all_ids, all_counts = np.concatenate(ids), np.concatenate(counts)
            put(f"{path}/shard-{task:08d}-{number:06d}.flwm", pack(all_ids, np.concatenate(keys), all_counts, np.concatenate(valid)))
            out = pa.RecordBatch.from_pydict({"part": pa.array([task], pa.int32()), "number": pa.array([number], pa.int32()), "documents": pa.array([len(all_counts)], pa.int64()), "tokens": pa.array([len(all_ids)], pa.int64())})
            number += 1
            for x in (ids, counts, keys, valid):
                x.clear()
            return out

        held = 0
        for batch in slices(batches, "__text", 1 << 23):
            got, count = encoder(tokenizer).encode(batch.column("__text"), end)
            k = batch.column("__key")
            ids.append(got)
            counts.append(count)
            keys.append(k.fill_null(0).to_numpy(zero_copy_only=False))
            valid.append(k.is_valid().to_numpy(zero_copy_only=False))
            held += len(got)
            if held >= SHARD_TOKENS:
                yield close()
                held = 0
        if counts:
            yield close()

    return rows.select("__key", "__text").mapInArrow(tidy(encode), "part int, number int, documents long, tokens long")


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the shards below ``path``: key, part, number, start within the shard, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.flwm").load(path).select("path", "content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                part, number = (int(x) for x in name.rpartition("/")[2].removeprefix("shard-").removesuffix(".flwm").split("-"))
                shard = Shard(content.as_py())
                raw = memoryview(shard.all().astype("<u4").tobytes())
                start = np.cumsum(shard.counts) - shard.counts
                crc = [zlib.crc32(raw[4 * s : 4 * (s + c)]) for s, c in zip(start.tolist(), shard.counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, mask=~shard.valid), *(pa.array(np.full(len(crc), v, np.int32)) for v in (part, number)), pa.array(start), pa.array(shard.counts), pa.array(crc, pa.int64())],
                    names=[key, "part", "number", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(tidy(decode), f"`{key}` long, part int, number int, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame, tokenizer: str, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents, then read each back: key, start over all shards, n_tokens, ids_crc32."""
    spark = documents.sparkSession
    path = fresh_dir(spark, "tokens")
    shards = cut(write(documents, tokenizer, path, end, key, text))  # a row a shard
    # parts are at most the shuffle partitions, so the window over all of them is small
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("all")).withColumn("__of", F.sum("all").over(Window.orderBy("part")) - F.col("all"))
    before = F.sum("tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("tokens") + F.col("__of")
    starts = shards.join(parts.select("part", "__of"), "part").select("part", "number", before.alias("__before"))
    return read(spark, path, key).join(starts, ["part", "number"]).select(key, (F.col("start") + F.col("__before")).alias("start"), "n_tokens", "ids_crc32")
