"""WARC writing, and a reader that salvages what it can from damaged archives.

Writing: one record a row, each a gzip member of its own. Of rows with equal payloads of at least
``least`` bytes, the one with the largest id is a response and the others are revisits that refer to
it; rows that tie at the largest id are all responses. Smaller payloads are always responses.

Reading: a record counts only if its member's checksum, its version line, headers, length and end
mark, and the SHA-1 of its payload are right. After a failed check the reader searches for the next
valid gzip member (or, within a member or a plain file, the next version line), goes on from there,
and logs the bytes between as a quarantined gap with the reason.

Nulls: a null payload is empty, a null id or address is left out of the headers and read back as
null (as an id it counts as the smallest). An empty table gives no file and no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.shared import cut, fresh_dir, tidy
from faultline.llm.wavelet import put

#: Compressed bytes after which a file is closed.
FILE_BYTES = 12 << 20
#: Copies of each representative that the rows of one digest are spread over.
SALT = 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes
    payload: bytes = b""


@dataclass
class Gap:
    offset: int
    length: int
    reason: str
    headers: dict[str, str] = field(default_factory=dict)


def record(kind: str, key: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A record's bytes, uncompressed."""
    head = [f"WARC-Type: {kind}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"X-Payload-Length: {len(payload)}"]
    name = f"{key}" if key is not None else f"none-{digest}"
    head.append(f"WARC-Record-ID: <urn:x-row:{name}>")
    if key is not None:
        head.append(f"X-Row-Key: {key}")
    if uri:
        head.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '%20', uri)}")
    block = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:x-row:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(raw: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _one(data: bytes, at: int) -> tuple[Record | None, int, str]:
    """The record at ``at``, where it ends, and what is wrong if there is none."""
    found = _VERSION.match(data, at)
    if not found:
        return None, at, "no version line"
    end = data.find(b"\r\n\r\n", found.end() - 2)
    if end < 0:
        return None, at, "headers do not end"
    headers: dict[str, str] = {}
    for line in data[found.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "bad header"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return None, at, "bad length"
    stop = end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None, at, "no end mark"
    out = Record(at, stop + 4 - at, headers, data[end + 4 : stop])
    if headers.get("content-type", "").startswith("application/http"):
        out.payload = out.block.partition(b"\r\n\r\n")[2]
    else:
        out.payload = out.block
    told = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and told.startswith("sha1:") and base64.b32encode(hashlib.sha1(out.payload).digest()).decode() != told[5:]:
        return None, at, "payload digest differs"
    return out, stop + 4, ""


def _plain(data: bytes, base: int = 0, inside: bool = False) -> Iterator[Record | Gap]:
    """Records and gaps of uncompressed data; ``inside`` a member, all have the member's offset."""
    at, bad, why = 0, -1, ""
    while at < len(data):
        got, end, reason = _one(data, at)
        if got is None:
            if bad < 0:
                bad, why = at, reason
            found = _VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if bad >= 0:
            yield Gap(base if inside else base + bad, got.offset - bad, why)
            bad = -1
        got.offset = base if inside else base + got.offset
        yield got
        at = end
    if bad >= 0:
        yield Gap(base if inside else base + bad, len(data) - bad, why)


def _member(data: bytes, at: int) -> tuple[bytes | None, int]:
    """A whole gzip member at ``at``, its checksum verified, and where it ends."""
    d = zlib.decompressobj(31)
    try:
        first = d.decompress(data[at : at + 512], 64)
        if not b"WARC/1.".startswith(first[:7]) or len(first) < 7:
            return None, at
        d = zlib.decompressobj(31)
        raw = d.decompress(memoryview(data)[at:])
    except zlib.error:
        return None, at
    return (raw, len(data) - len(d.unused_data)) if d.eof else (None, at)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and quarantined gaps of a file, compressed member by member or plain; the two cover it."""
    at = bad = 0
    if data[:5] == b"WARC/" or MAGIC not in data:
        yield from _plain(data)
        return
    while at < len(data):
        raw, end = _member(data, at) if data[at : at + 3] == MAGIC else (None, at)
        if raw is None:
            at = data.find(MAGIC, at + 1)
            at = len(data) if at < 0 else at
            continue
        if at > bad:
            yield Gap(bad, at - bad, "no valid member")
        for x in _plain(raw, at, inside=True):
            x.length = end - at
            yield x
        at = bad = end
    if at > bad:
        yield Gap(bad, at - bad, "no valid member")


def plan_records(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html", least: int = 1000) -> DataFrame:
    """Per row: key, uri, payload, digest, record_type and refers_to.

    Digests are counted first; only those that repeat take part in the join, and the rows of one
    digest are spread over ``SALT`` keys, so a payload that fills a third of the table is no hot key.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), body.alias("payload")).withColumn("digest", F.sha1("payload")).withColumn("__n", F.length("payload"))
    copies = rows.where(F.col("__n") >= least).groupBy("digest").agg(F.max("key").alias("__first"), F.count(F.lit(1)).alias("__copies")).where("__copies > 1")
    copies = copies.select("digest", "__first", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("__salt"))
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("key", "uri"), F.lit(SALT)).cast("int"))
    out = rows.join(copies, ["digest", "__salt"], "left")
    again = F.col("__first").isNotNull() & ~F.col("key").eqNullSafe(F.col("__first")) & (F.col("__n") >= least)
    return out.select("key", "uri", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("__first")).alias("refers_to"))


def write(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives below ``path``; per file: name, records, bytes. A task that runs twice writes the same names."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, size
            name = f"part-{task:08d}-{number:06d}.warc.gz"
            put(f"{path}/{name}", b"".join(held))
            out = pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([len(held)], pa.int64()), "bytes": pa.array([size], pa.int64())})
            held.clear()
            number, size = number + 1, 0
            return out

        for batch in batches:
            cols = [batch.column(c) for c in ("record_type", "key", "uri", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                member = compressed(record(*(c[i].as_py() for c in cols), date))
                held.append(member)
                size += len(member)
                if size >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    system.create_dir(at)
    return records.mapInArrow(tidy(pack), "file string, records long, bytes long")


SCHEMA = "file string, kind string, offset long, length long, reason string, key long, record_type string, refers_to long, uri string, payload_bytes long, payload_digest string, payload binary"


def _row(name: str, x: Record | Gap, payloads: bool) -> dict:
    if isinstance(x, Gap):
        return {"file": name, "kind": "gap", "offset": x.offset, "length": x.length, "reason": x.reason}
    h = x.headers
    told = h.get("warc-payload-digest", "")
    revisit = h.get("warc-type") == "revisit"
    number = lambda s: int(s) if re.fullmatch(r"-?\d{1,19}", s or "") else None
    return {
        "file": name, "kind": "record", "offset": x.offset, "length": x.length, "key": number(h.get("x-row-key")), "record_type": h.get("warc-type"),
        "refers_to": number(h.get("warc-refers-to", "").removeprefix("<urn:x-row:").removesuffix(">")), "uri": h.get("warc-target-uri"),
        "payload_bytes": number(h.get("x-payload-length")) if revisit else len(x.payload),
        "payload_digest": base64.b32decode(told[5:]).hex() if told.startswith("sha1:") else hashlib.sha1(x.payload).hexdigest(),
        "payload": x.payload if payloads and not revisit else None,
    }


def read(spark: SparkSession, path: str, glob: str = "*.warc*", payloads: bool = False) -> DataFrame:
    """Records (kind ``record``) and quarantined gaps (kind ``gap``) of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, SCHEMA.split(", "), strict=True)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held, size = [], 0
                for x in salvage(content.as_py()):
                    held.append(_row(name.rpartition("/")[2], x, payloads))
                    size += len(x.payload) if isinstance(x, Record) and payloads else 100
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return files.mapInArrow(tidy(scan), SCHEMA)


def round_trip(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """Write all rows, then read the archives back: records and gaps."""
    spark = pages.sparkSession
    path = fresh_dir(spark, "warc")
    if cut(write(plan_records(pages, key, uri, html), path)).isEmpty():
        return spark.createDataFrame([], SCHEMA)
    return read(spark, path)
