"""Generic relational tables seen as the engine's logical tables, for Spark and (as common table expressions) for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.scalar import np_round, site_class


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind, n = F.col("event_type"), F.col("event_id")
    return e.select(
        n.cast("string").alias("event_id"), n.cast("string").alias("source_event_id"),
        F.when(n % 3 == 0, "usgs").when(n % 3 == 1, "isc").otherwise("emsc").alias("source"),
        F.col("ts").cast("timestamp").alias("time_utc"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("t_sec"),
        (F.lit(38.0) + (F.col("user_id") % 10) * 0.1).alias("latitude"), (F.lit(36.0) + (F.col("user_id") % 7) * 0.1).alias("longitude"),
        (F.col("user_id") % 30).cast("double").alias("depth_km"), (F.lit(3.0) + F.least(F.col("value"), F.lit(480.0)) / 100.0).alias("magnitude"),
        F.when(kind == "error", "mb").when(kind == "click", "ml").when(kind == "view", "mw").when(kind == "purchase", "md").otherwise("ms").alias("mag_type"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    out = s.select(
        F.col("s_suppkey").cast("string").alias("station"), (F.lit(35.0) + (F.col("s_suppkey") % 80) * 0.1).alias("latitude"), (F.lit(26.0) + F.col("s_nationkey") * 0.7).alias("longitude"),
        (F.col("s_suppkey") % 2 == 0).alias("has_strong_motion"), (F.lit(150.0) + F.abs("s_acctbal") / 10.0).alias("vs30_ms"),
    )
    return out.withColumn("nehrp_site_class", site_class(F.col("vs30_ms")))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    pga = F.col("l_extendedprice") / 1e5
    strong = F.col("l_returnflag") != "R"
    out = x.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("file"), F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_suppkey").cast("string").alias("station"),
        pga.alias("pga_g"), (F.col("l_quantity") * F.col("l_tax") * 10.0).alias("pgv_cms"), (F.col("l_discount") * 100.0).alias("snr_db"),
        strong.alias("usable_for_engineering"), F.when(strong, "strong_motion").otherwise("broadband").alias("instrument_type_used"), F.lit(0.1).alias("highpass_corner_hz"),
        F.when(F.col("l_linestatus") == "F", F.unix_micros(F.col("l_shipdate").cast("timestamp"))).alias("p_pick_time"),
        F.when(F.col("l_linestatus") == "F", F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (F.col("l_quantity") * 1e6).cast("long")).alias("s_pick_time"),
        pga.alias("pga_h1_g"), (pga * (F.lit(1.0) - F.col("l_discount"))).alias("pga_h2_g"), (pga * 0.5).alias("pga_v_g"),
        F.col("l_quantity").alias("duration_sec"), (F.col("l_linestatus") == "F").alias("usable_for_phase_picking"),
    )
    return out.withColumn("pga_geomean_g", F.sqrt(F.col("pga_h1_g") * F.col("pga_h2_g"))).withColumn("pga_rotd50_g", (F.col("pga_h1_g") + F.col("pga_h2_g")) / 2)


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("n"), (F.col("o_custkey") % 97).cast("string").alias("event_id"), F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "no_data").otherwise("error").alias("status"), F.col("o_totalprice").alias("distance_km"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three traces a file (E, N, Z), 64 samples at 100 Hz."""
    v = F.col("vec_id")
    channel = F.when(v % 3 == 0, "HNE").when(v % 3 == 1, "HNN").otherwise("HNZ")
    return table(spark, sf_dir, "embeddings").select(
        F.call_function("div", v, F.lit(3)).cast("string").alias("file"), channel.alias("channel"), F.timestamp_micros(F.lit(1_600_000_000_000_000) + (v % 3) * 20_000).alias("start_ts"),
        F.lit(100.0).alias("sampling_rate_hz"), F.col("embedding").cast("array<double>").alias("samples"),
    )


def r6(name: str) -> object:
    return np_round(F.col(name), 6).alias(name)


# --- the same views for DuckDB ---
CATALOG = """catalog as (select cast(event_id as varchar) as event_id, cast(event_id as varchar) as source_event_id,
  case event_id % 3 when 0 then 'usgs' when 1 then 'isc' else 'emsc' end as source, epoch_us(ts) / 1e6 as t_sec, epoch_us(ts) as t_us,
  38e0 + (user_id % 10) * 1e-1 as latitude, 36e0 + (user_id % 7) * 1e-1 as longitude, cast(user_id % 30 as double) as depth_km,
  3e0 + least(value, 480e0) / 1e2 as magnitude,
  case event_type when 'error' then 'mb' when 'click' then 'ml' when 'view' then 'mw' when 'purchase' then 'md' else 'ms' end as mag_type from events)"""
SITE = "case when {v} is null or isnan({v}) or isinf({v}) or {v} <= 0 then null when {v} > 1500 then 'A' when {v} > 760 then 'B' when {v} > 360 then 'C' when {v} > 180 then 'D' else 'E' end"
STATIONS = f"""stations as (select *, {SITE.format(v="vs30_ms")} as nehrp_site_class from (select cast(s_suppkey as varchar) as station,
  35e0 + (s_suppkey % 80) * 1e-1 as latitude, 26e0 + s_nationkey * 7e-1 as longitude, s_suppkey % 2 = 0 as has_strong_motion, 150e0 + abs(s_acctbal) / 10e0 as vs30_ms from supplier))"""
FEATURES = """features as (select *, sqrt(pga_h1_g * pga_h2_g) as pga_geomean_g, (pga_h1_g + pga_h2_g) / 2e0 as pga_rotd50_g from (
  select l_orderkey || '_' || l_linenumber as file, cast(l_orderkey as varchar) as event_id, cast(l_suppkey as varchar) as station,
  l_extendedprice / 1e5 as pga_g, l_quantity * l_tax * 1e1 as pgv_cms, l_discount * 1e2 as snr_db, l_returnflag <> 'R' as usable_for_engineering,
  case when l_returnflag <> 'R' then 'strong_motion' else 'broadband' end as instrument_type_used, 1e-1 as highpass_corner_hz,
  case when l_linestatus = 'F' then epoch_us(l_shipdate) end as p_pick_time, case when l_linestatus = 'F' then epoch_us(l_shipdate) + cast(l_quantity * 1e6 as bigint) end as s_pick_time,
  l_extendedprice / 1e5 as pga_h1_g, l_extendedprice / 1e5 * (1e0 - l_discount) as pga_h2_g, l_extendedprice / 1e5 * 5e-1 as pga_v_g,
  l_quantity as duration_sec, l_linestatus = 'F' as usable_for_phase_picking from lineitem))"""
LOG = """fetch_log as (select o_orderkey as n, cast(o_custkey % 97 as varchar) as event_id, case o_orderstatus when 'F' then 'ok' when 'O' then 'no_data' else 'error' end as status, o_totalprice as distance_km from orders)"""
TRACES = """traces as (select cast(vec_id // 3 as varchar) as file, case vec_id % 3 when 0 then 'HNE' when 1 then 'HNN' else 'HNZ' end as channel,
  1600000000000000 + (vec_id % 3) * 20000 as start_us, 1e2 as sampling_rate_hz, cast(embedding as double[]) as samples from embeddings)"""


def round6(x: str, places: int = 6) -> str:
    return f"round_even(({x}) * 1e{places}, 0) / 1e{places}"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(case when {lat1} + {lon1} + {lat2} + {lon2} is not null then 12742e0 * asin(sqrt(least(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2), 1e0))) end)"


SCALE = "case lower(coalesce(mag_type, '')) when 'mw' then 'moment_magnitude' when 'mww' then 'moment_magnitude' when 'mwc' then 'moment_magnitude' when 'mwr' then 'moment_magnitude' when 'mwb' then 'moment_magnitude' when 'md' then 'duration_magnitude' when 'ml' then 'local_magnitude' when 'mb' then 'body_wave_magnitude' when 'mblg' then 'body_wave_magnitude' when 'ms' then 'surface_wave_magnitude' else 'diger' end"
MW = f"case when {SCALE} = 'moment_magnitude' then magnitude when {SCALE} = 'local_magnitude' then {round6('7018e-4 * magnitude + 11715e-4', 2)} end"
