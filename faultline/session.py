"""Session settings that the engine is made for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build(master: str | None = None, name: str = "faultline", **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | extra).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a local one only where the session names none."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and context._jsc.sc().getCheckpointDir().isDefined():
        return context._jsc.sc().getCheckpointDir().get()
    if not found:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="faultline-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(found)
    return found


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared folder: plans that use it several times do not repeat it, nor does a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
