"""Event-station facts and the event dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import estimate_mw, haversine_km, hypocentral_km, np_round, scale_group
from faultline.operators.joins import nearest


def join_distances(features: DataFrame, events: DataFrame, stations: DataFrame) -> DataFrame:
    """Features with their event (inner) and station (left), epicentral and hypocentral distance (2 places; the second from the rounded first)."""
    out = features.join(events, "event_id").join(stations, "station", "left")
    epi = np_round(haversine_km(F.col("event_latitude"), F.col("event_longitude"), F.col("station_latitude"), F.col("station_longitude")), 2)
    out = out.withColumn("epicentral_distance_km", epi)
    return out.withColumn("hypocentral_distance_km", np_round(hypocentral_km(F.col("epicentral_distance_km"), F.col("depth_km")), 2))


def with_magnitudes(events: DataFrame) -> DataFrame:
    out = events.withColumn("magnitude_scale_group", scale_group(F.col("mag_type")))
    return out.withColumn("mw_estimate", estimate_mw(F.col("magnitude_scale_group"), F.col("magnitude")))


def with_nearest(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest station, nearest strong-motion station and the latter's site, distances to 2 places."""
    places = stations.select("station", "latitude", "longitude", "has_strong_motion")
    out = nearest(events, places, "station", {"nearest_station": F.col("station").isNotNull(), "nearest_strong_motion_station": F.col("has_strong_motion")})
    site = stations.select(F.col("station").alias("nearest_strong_motion_station"), F.col("vs30_ms").alias("nearest_sm_vs30_ms"), F.col("nehrp_site_class").alias("nearest_sm_site_class"))
    for c in ("nearest_station_distance_km", "nearest_strong_motion_station_distance_km"):
        out = out.withColumn(c, np_round(F.col(c), 2))
    return out.join(site, "nearest_strong_motion_station", "left")


def event_aggregates(features: DataFrame) -> DataFrame:
    """Per event: files, best engineering peaks, best of all, any phase pick. One pass, one shuffle."""
    usable = F.col("usable_for_engineering")
    return features.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("num_waveform_files"),
        F.max(F.when(usable, F.col("pga_g"))).alias("eng_pga_g"), F.max(F.when(usable, F.col("pgv_cms"))).alias("eng_pgv_cms"),
        F.max("pga_g").alias("any_pga_g"), F.max("pgv_cms").alias("any_pgv_cms"), F.max("snr_db").alias("best_snr_db"),
        F.bool_or(F.col("p_pick_time").isNotNull()).alias("has_phase_pick"),
    )


def event_dataset(events: DataFrame, stations: DataFrame, features: DataFrame) -> DataFrame:
    """One row an event: magnitudes, nearest stations, file counts, peaks (engineering records first, then any)."""
    out = with_nearest(with_magnitudes(events), stations).join(event_aggregates(features), "event_id", "left")
    n = F.coalesce("num_waveform_files", F.lit(0).cast("long"))
    return out.withColumns(
        {
            "num_waveform_files": n, "has_waveform": n > 0, "has_phase_pick": F.coalesce("has_phase_pick", F.lit(False)),
            "pga_from_strong_motion": F.col("eng_pga_g").isNotNull(),
            "max_pga_g": F.coalesce("eng_pga_g", "any_pga_g"), "max_pgv_cms": F.coalesce("eng_pgv_cms", "any_pgv_cms"),
        }
    ).drop("eng_pga_g", "eng_pgv_cms", "any_pga_g", "any_pgv_cms")
