"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a temporary folder is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        had = jsc.getCheckpointDir()
        if had.isDefined():
            return had.get()
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="faultline-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and reread from the shared folder, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of the shared folder."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text (a longer text is a slice of its own)."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column(column)
        off = np.frombuffer(at.buffers()[1], dtype=np.int64 if pa.types.is_large_string(at.type) else np.int32)[at.offset : at.offset + len(at) + 1].astype(np.int64)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + most, side="right")) - 1
            end = min(batch.num_rows, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end


def tidy(run):
    """``run`` over a task's batches, after which the worker gives freed memory back: workers are kept for later tasks."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def release() -> None:
    import ctypes
    import gc

    from faultline.llm import textvec

    textvec.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass
