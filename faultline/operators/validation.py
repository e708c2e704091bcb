"""The whole validation of a data set, in full or quick, over the checks of ``quality``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import quality
from faultline.operators.splits import CUTOFF
from faultline.sources import tables


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_splits(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Splits that are there: ``events`` (task, split, event_id; tasks that have all three), ``station`` (split, station), ``time`` (split, time_utc)."""
    out: dict[str, DataFrame] = {}

    def read(task: str, names: tuple[str, ...], column: str, holdout: str | None = None) -> list[DataFrame]:
        paths = {n: tables.benchmark_path(task, n, holdout, base) for n in names}
        there = {n: p for n, p in paths.items() if exists(spark, p)}
        if holdout is None and len(there) < len(paths):
            return []
        return [spark.read.parquet(p).select(F.lit(task).alias("task"), F.lit(n).alias("split"), F.col(column).cast("string").alias(column)) for n, p in there.items()]

    events = [df for task in tables.TASKS for df in read(task, ("train", "val", "test"), "event_id")]
    if events:
        out["events"] = quality.union_all(events)
    for holdout, names, column in (("station", ("train", "val", "test"), "station"), ("time", ("train", "test"), "time_utc")):
        found = read("ground_motion", names, column, holdout)
        if found:
            out[holdout] = quality.union_all(found).drop("task")
    return out


def _absent(spark: SparkSession, name: str) -> DataFrame:
    return spark.range(1).select(F.lit(name).alias("check"), F.lit(False).alias("passed"), F.lit(0).cast("long").alias("detail"))


def validate(
    events: DataFrame, stations: DataFrame, features: DataFrame, facts: DataFrame | None = None, splits: dict[str, DataFrame] | None = None,
    files: DataFrame | None = None, log: DataFrame | None = None, decode: Callable[[bytes], Iterable] | None = None, quick: bool = False, cutoff: str = CUTOFF,
) -> DataFrame:
    """All checks as (check, passed, detail). Without ``facts`` its check fails; other missing tables or columns skip theirs.

    ``files`` has the waveform files (path, and content where they are to be decoded). ``quick`` leaves
    out the decoding of files, and nothing else.
    """
    spark, splits = events.sparkSession, splits or {}
    parts = [quality.structural(events, stations, features), quality.plausibility(features), quality.horizontal(features), quality.phase_order(features), quality.dedup_quality(events)]
    parts.append(_absent(spark, "event_station_not_empty") if facts is None else quality.geometry(facts))
    if facts is not None and "events" in splits:
        parts.append(quality.leakage(facts, splits["events"]))
    if "station" in splits:
        parts.append(quality.station_holdout(splits["station"]))
    if "time" in splits:
        parts.append(quality.time_holdout(splits["time"], cutoff))
    if files is not None:
        n = files.agg(F.count(F.lit(1)).alias("n"))
        parts.append(quality.count_matches(n, events.agg(F.coalesce(F.sum("num_waveform_files"), F.lit(0)).alias("n")), "files_match_events"))
        if log is not None:
            parts.append(quality.count_matches(log.agg(F.count_if(F.col("status") == "ok").alias("n")), n, "log_matches_files"))
        if decode is not None and not quick:
            parts.append(quality.readable_files(files, decode))
    return quality.union_all([p.select("check", "passed", F.col("detail").cast("long").alias("detail")) for p in parts if p is not None])
