"""Streaming twins of batch operators: sessions, deduplication, record windows, windows after a pick."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.windows import RECORD, RECORD_AFTER, RECORD_BEFORE


def session_groups(events: DataFrame, key: str = "event_id", time: str = "time_utc", gap: float = RECORD, late: str = "10 minutes", by: tuple[str, ...] = ()) -> DataFrame:
    """Sessions (touching ones are one): ``by``, start, end, window_group (first id), n. Works on batches, too.

    Streams keep sessions by key; without ``by`` (a region, say) all events are of one key, which one task holds.
    """
    w = F.session_window(time, f"{gap:g} seconds")
    keys = [F.col(c) for c in by] or [F.col(time).isNull().alias("__one")]
    out = events.withWatermark(time, late).groupBy(*keys, w.alias("w")).agg(F.min(F.struct(time, key)).alias("first"), F.count(F.lit(1)).alias("n"))
    return out.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.col(f"first.{key}").alias("window_group"), "n")


def first_of_each(events: DataFrame, keys: list[str], time: str = "time_utc", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def record_overlaps(events: DataFrame, others: DataFrame, lookback: float = 120.0, late: str = "10 minutes") -> DataFrame:
    """Stream-stream join: events (event_id, time_utc, magnitude) with other events in their record window."""
    a = events.withWatermark("time_utc", late)
    b = others.select(F.col("event_id").alias("other_id"), F.col("time_utc").alias("other_time"), F.col("magnitude").alias("other_magnitude")).withWatermark("other_time", late)
    on = F.expr(f"other_time between time_utc - interval {RECORD_BEFORE + lookback:g} seconds and time_utc + interval {RECORD_AFTER:g} seconds and other_id <> event_id")
    return a.join(b, on)


def peaks_after_pick(samples: DataFrame, windows: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Stateful: rows (event_id, station, seconds after the pick, amplitude) to the largest amplitude of each window.

    State is one number a window and the latest second; a row comes out whenever a batch raises a peak.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        peaks = list(state.get) if state.exists else [0.0] * len(windows)
        for b in batches:
            for i, w in enumerate(windows):
                inside = b[(b.sec >= 0) & (b.sec < w)]
                if len(inside):
                    peaks[i] = max(peaks[i], float(inside.amplitude.abs().max()))
        state.update(tuple(peaks))
        yield pd.DataFrame([(*key, *peaks)], columns=["event_id", "station", *(f"peak_{w}s" for w in windows)])

    kinds = ", ".join(f"peak_{w}s double" for w in windows)
    return samples.groupBy("event_id", "station").applyInPandasWithState(update, f"event_id string, station string, {kinds}", ", ".join(f"p{w} double" for w in windows), "update", "NoTimeout")


def late_corrections(facts: DataFrame, id_map: DataFrame) -> DataFrame:
    """Streaming facts with the ids of the present id map: a static side is reread in every batch."""
    from faultline.operators.joins import remap

    return remap(facts, id_map)
