"""Deterministic splits that leak nothing: by hash, by cumulative share of stations, by time; and the three tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN, VAL = 0.70, 0.15
CUTOFF = "2022-01-01"


def hash_fraction(key: Column) -> Column:
    """The first 32 bits of the key's MD5, from 0 to 1."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


def _named(share: Column) -> Column:
    return F.when(share < TRAIN, "train").when(share < TRAIN + VAL, "val").otherwise("test")


def hash_split(key: Column) -> Column:
    return _named(hash_fraction(key))


def split_key(df: DataFrame) -> Column:
    return F.coalesce("window_group", "event_id") if "window_group" in df.columns else F.col("event_id")


def station_split(records: DataFrame, station: str = "station") -> DataFrame:
    """Per station: n and split. Stations stand in the order of their MD5; the middle of a station's records decides.

    The running sum is over one row a station; it runs bucket by bucket of the hash's first byte, and
    only the 256 bucket totals meet in one task.
    """
    counts = records.groupBy(station).agg(F.count(F.lit(1)).alias("n")).withColumn("__h", F.md5(F.concat(F.lit("station_"), F.col(station).cast("string")).cast("binary")))
    counts = counts.withColumn("__b", F.substring("__h", 1, 2))
    totals = counts.groupBy("__b").agg(F.sum("n").alias("__t"))
    every = Window.orderBy("__b")
    totals = totals.select("__b", F.coalesce(F.sum("__t").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__t").over(Window.partitionBy()).alias("__all"))
    run = F.sum("n").over(Window.partitionBy("__b").orderBy("__h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = (F.col("__before") + run - F.col("n") / 2) / F.col("__all")
    return counts.join(F.broadcast(totals), "__b").withColumn("split", _named(middle)).select(station, "n", "split")


def time_split(time: Column, cutoff: str = CUTOFF) -> Column:
    return F.when(time < F.to_timestamp(F.lit(cutoff)), "train").otherwise("test")


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def ground_motion_task(facts: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """Usable, unambiguous rows with all required columns, and their split."""
    rows = facts.where("usable_for_engineering")
    if "label_ambiguous" in facts.columns:
        rows = rows.where(~F.coalesce("label_ambiguous", F.lit(False)))
    rows = rows.dropna(subset=required)
    return rows.withColumn("split", hash_split(split_key(rows))).select(*required, *_present(rows, optional), "split")


def phase_picking_task(facts: DataFrame) -> DataFrame:
    rows = facts.where("usable_for_phase_picking").dropna(subset=["p_pick_time"])
    columns = _present(rows, ["event_id", "station", "file", "p_pick_time", "s_pick_time", "p_pick_confidence", "s_pick_confidence", "sampling_rate_hz"])
    return rows.withColumn("split", hash_split(split_key(rows))).select(*columns, "split")


def early_warning_task(facts: DataFrame, least_seconds: float = 10.0, windows: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    rows = facts.where(F.col("mw_estimate").isNotNull() & F.col("p_pick_time").isNotNull() & (F.col("duration_sec") >= least_seconds))
    rows = rows.withColumn("split", hash_split(split_key(rows))).withColumn("available_windows_sec", F.lit(",".join(map(str, windows))))
    columns = _present(rows, ["event_id", "station", "file", "p_pick_time", "magnitude", "mag_type", "mw_estimate", "epicentral_distance_km", "hypocentral_distance_km", "available_windows_sec"])
    return rows.select(*columns, "split")
