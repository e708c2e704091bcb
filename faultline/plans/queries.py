"""One query for every operator, on generic tables, and its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions import gmpe
from faultline.functions import scalar as S
from faultline.operators import dedup, facts, joins, quality, reports, review, splits, stats, validation, waveform, windows
from faultline.operators import kernels as K
from faultline.plans import bindings as B
from faultline.plans.bindings import catalog, features, fetch_log, km, r6, round6, stations, table, traces
from faultline.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- scans, scalar functions ---
@query("select l_orderkey, l_extendedprice from lineitem where l_quantity > 45")
def parquet_scan_pruned(spark, d):
    return table(spark, d, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_extendedprice")


@query(f"""with {B.CATALOG} select event_id, {B.SCALE} as magnitude_scale_group, {round6(B.MW)} as mw_estimate,
case when magnitude >= 65e-1 then 3e-2 when magnitude >= 55e-1 then 5e-2 else 1e-1 end as highpass_corner_hz from catalog""")
def magnitude_functions(spark, d):
    out = facts.with_magnitudes(catalog(spark, d)).withColumn("highpass_corner_hz", S.highpass_corner(F.col("magnitude")))
    return out.select("event_id", "magnitude_scale_group", r6("mw_estimate"), "highpass_corner_hz")


@query(f"with {B.STATIONS} select station, {round6('vs30_ms')} as vs30_ms, nehrp_site_class from stations")
def site_classes(spark, d):
    return stations(spark, d).select("station", r6("vs30_ms"), "nehrp_site_class")


@query("""select safe, safe_back = id as round_trip, id from (select id, safe, replace(replace(replace(safe, '-e-', '='), '-s-', '/'), '-c-', ':') as safe_back
from (select 'smi:X/evid=' || event_id as id, replace(replace(replace('smi:X/evid=' || event_id, ':', '-c-'), '/', '-s-'), '=', '-e-') as safe from events))""")
def id_codec(spark, d):
    ids = table(spark, d, "events").select(F.concat(F.lit("smi:X/evid="), F.col("event_id").cast("string")).alias("id"))
    ids = ids.withColumn("safe", S.sanitize_id(F.col("id")))
    return ids.select("safe", (S.desanitize_id(F.col("safe")) == F.col("id")).alias("round_trip"), "id")


@query("""select regexp_extract(file, '^(.*)_([^_]+)$', 1) as event, regexp_extract(file, '^(.*)_([^_]+)$', 2) as station, count(*) as n
from (select 'a_' || l_orderkey || '_' || l_suppkey as file from lineitem) group by all""")
def file_names(spark, d):
    f = table(spark, d, "lineitem").select(F.concat_ws("_", F.lit("a"), "l_orderkey", "l_suppkey").alias("file"))
    event, station = S.split_file_name(F.col("file"))
    return f.groupBy(event.alias("event"), station.alias("station")).agg(F.count(F.lit(1)).alias("n"))


@query("""with c as (select p_partkey, [case p_size % 4 when 0 then 'HNZ' when 1 then 'HHZ' when 2 then 'EHZ' else 'HXZ' end, case when p_size % 3 = 0 then 'HNE' else 'BHE' end] as codes from part)
select p_partkey, coalesce(nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform(codes, lambda x: case x[2] when 'N' then 'strong_motion' when 'H' then 'broadband' when 'L' then 'short_period' when 'E' then 'short_period' end), lambda t: t is not null))), ','), ''), 'bilinmiyor') as instrument_types,
len(list_filter(codes, lambda x: x[2] = 'N')) > 0 as has_strong_motion from c""")
def instrument_types(spark, d):
    size = F.col("p_size")
    codes = F.array(F.when(size % 4 == 0, "HNZ").when(size % 4 == 1, "HHZ").when(size % 4 == 2, "EHZ").otherwise("HXZ"), F.when(size % 3 == 0, "HNE").otherwise("BHE"))
    p = table(spark, d, "part").select("p_partkey", codes.alias("codes"))
    return p.select("p_partkey", S.instrument_types(F.col("codes")).alias("instrument_types"), S.has_strong_motion(F.col("codes")).alias("has_strong_motion"))


# --- nearest, candidates ---
_NEAREST = f"""with {B.CATALOG}, {B.STATIONS}, place as (select distinct latitude as la, longitude as lo from catalog),
pair as (select la, lo, station, has_strong_motion, {km("la", "lo", "latitude", "longitude")} as d from place, stations),
any_one as (select la, lo, min((round_even(d * 1e9, 0), station)) as b from pair group by all), sm as (select la, lo, min((round_even(d * 1e9, 0), station)) as b from pair where has_strong_motion group by all)"""


@query(f"""{_NEAREST} select event_id, {B.SCALE} as magnitude_scale_group, {round6(B.MW)} as mw_estimate, any_one.b[2] as nearest_station, {round6("any_one.b[1] / 1e9", 2)} as nearest_station_distance_km,
sm.b[2] as nearest_strong_motion_station, {round6("sm.b[1] / 1e9", 2)} as nearest_strong_motion_station_distance_km, {round6("s.vs30_ms")} as nearest_sm_vs30_ms, s.nehrp_site_class as nearest_sm_site_class
from catalog join any_one on catalog.latitude = any_one.la and catalog.longitude = any_one.lo left join sm on catalog.latitude = sm.la and catalog.longitude = sm.lo left join stations s on s.station = sm.b[2]""")
def nearest_station(spark, d):
    out = facts.with_nearest(facts.with_magnitudes(catalog(spark, d)), stations(spark, d))
    return out.select("event_id", "magnitude_scale_group", r6("mw_estimate"), "nearest_station", "nearest_station_distance_km", "nearest_strong_motion_station", "nearest_strong_motion_station_distance_km", r6("nearest_sm_vs30_ms"), "nearest_sm_site_class")


@query(f"""with {B.CATALOG}, {B.STATIONS}, e as (select * from catalog where magnitude >= 75e-1),
pair as (select event_id, station, {round6(km("e.latitude", "e.longitude", "s.latitude", "s.longitude"))} as distance_km from e, stations s where s.has_strong_motion)
select * from (select event_id, station, distance_km, row_number() over (partition by event_id order by distance_km, station) as rank from pair where distance_km <= 400) where rank <= 12""")
def k_nearest_stations(spark, d):
    e = catalog(spark, d).where("magnitude >= 7.5").select("event_id", "latitude", "longitude")
    s = stations(spark, d).select("station", F.col("latitude").alias("slat"), F.col("longitude").alias("slon"), "has_strong_motion")
    distance = S.np_round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.col("slat"), F.col("slon")), 6)
    return joins.k_nearest(e, s, "event_id", "station", distance, 12, 400.0, F.col("has_strong_motion")).select("event_id", "station", "distance_km", "rank")


@query(f"""with {B.CATALOG}, {B.STATIONS}, e as (select * from catalog where magnitude >= 45e-1),
pair as (select event_id, station, {round6(km("e.latitude", "e.longitude", "s.latitude", "s.longitude"))} as distance_km from e, stations s where s.has_strong_motion)
select * from (select event_id, station, distance_km, row_number() over (partition by event_id order by distance_km, station) as rank from pair where distance_km <= 400) where rank <= 12""")
def k_nearest_stations_m45(spark, d):
    """As k_nearest_stations, from the reference's least magnitude on."""
    e = catalog(spark, d).where("magnitude >= 4.5").select("event_id", "latitude", "longitude")
    s = stations(spark, d).select("station", F.col("latitude").alias("slat"), F.col("longitude").alias("slon"), "has_strong_motion")
    distance = S.np_round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.col("slat"), F.col("slon")), 6)
    return joins.k_nearest(e, s, "event_id", "station", distance, 12, 400.0, F.col("has_strong_motion")).select("event_id", "station", "distance_km", "rank")


@query(f"""with {B.LOG} select event_id, n, status from (select *, sum(cast(status = 'ok' as int)) over (partition by event_id order by distance_km, n rows unbounded preceding) - cast(status = 'ok' as int) as before from fetch_log) where before < 4""")
def until_four_successes(spark, d):
    return joins.until_successes(fetch_log(spark, d), "event_id", ["distance_km", "n"], F.col("status") == "ok", 4).select("event_id", "n", "status")


_CHANNELS = """channels as (select cast(p_partkey % 100 + 1 as varchar) as station, case p_size % 3 when 0 then 'strong_motion' when 1 then 'broadband' else 'short_period' end as instrument_type,
case when p_size % 5 = 0 then null else epoch_us(timestamp '2024-01-01') + p_size * 86400000000 // 4 end as start_date, case when p_size % 7 = 0 then null else epoch_us(timestamp '2024-01-01') + (p_size + 10) * 86400000000 // 4 end as end_date from part)"""


def channels(spark, d):
    size, base, quarter = F.col("p_size").cast("long"), 1_704_067_200_000_000, 86_400_000_000
    return table(spark, d, "part").select(
        (F.col("p_partkey") % 100 + 1).cast("string").alias("station"), F.when(size % 3 == 0, "strong_motion").when(size % 3 == 1, "broadband").otherwise("short_period").alias("instrument_type"),
        F.when(size % 5 != 0, base + F.call_function("div", size * quarter, F.lit(4))).alias("start_date"), F.when(size % 7 != 0, base + F.call_function("div", (size + 10) * quarter, F.lit(4))).alias("end_date"),
    )


@query(f"""with {_CHANNELS}, e as (select event_id, cast(user_id % 100 + 1 as varchar) as station, epoch_us(ts) as t from events)
select event_id from e where exists (select 1 from channels c where c.station = e.station and (start_date is null or start_date <= t) and (end_date is null or t <= end_date))""")
def active_channels(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 100 + 1).cast("string").alias("station"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return joins.active_at(e, channels(spark, d), "station", "t").select("event_id")


@query(f"with {_CHANNELS} select station, instrument_type, min(start_date) as start_date, max(end_date) as end_date from channels group by all")
def activity_envelope(spark, d):
    return joins.activity_envelope(channels(spark, d))


# --- sessions and context ---
_GROUPS = """grp as (select event_id, t_us, first_value(event_id) over (partition by s order by t_us, event_id) as window_group from (
select *, sum(n) over (order by t_us, event_id rows unbounded preceding) as s from (select event_id, t_us, cast(coalesce(t_us - lag(t_us) over (order by t_us, event_id) > {gap}, true) as int) as n from catalog)))"""


@query(f"with {B.CATALOG}, {_GROUPS.format(gap=210000000)} select event_id, window_group from grp")
def window_groups(spark, d):
    return windows.sessionize(catalog(spark, d).select("event_id", "t_sec"), "event_id", "t_sec").select("event_id", "window_group")


@query(f"""with {B.CATALOG}, {_GROUPS.format(gap=210000000)}, other as (select a.event_id, max(b.magnitude) as m from catalog a join catalog b on b.t_us between a.t_us - 130000000 and a.t_us + 200000000 and a.event_id <> b.event_id group by all)
select c.event_id, window_group, {round6("m")} as window_other_max_magnitude, coalesce(m >= magnitude, false) as label_ambiguous from catalog c join grp using (event_id) left join other o on o.event_id = c.event_id""")
def window_context(spark, d):
    c = catalog(spark, d)
    return windows.window_context(c.select("event_id", "magnitude"), c).select("event_id", "window_group", r6("window_other_max_magnitude"), "label_ambiguous")


@query(f"""with {B.CATALOG} select a.event_id, {round6("max(b.magnitude)")} as window_max from catalog a join catalog b on b.t_us between a.t_us - 130000000 and a.t_us + 200000000 group by all""")
def window_maximum(spark, d):
    c = catalog(spark, d)
    return joins.range_max(c.select("event_id", "t_sec"), c, "event_id", "t_sec", "event_id", "t_sec", "magnitude", 130.0, 200.0, False, "window_max").select("event_id", r6("window_max"))


@query("""select event_id, last_value(v ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as v from (select *, case when event_type = 'purchase' then value end as v from events)""")
def forward_fill(spark, d):
    e = table(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return windows.forward_fill(e, ["user_id"], ["ts", "event_id"], "v").select("event_id", "v")


# --- entity resolution ---
_PAIR = f"""select a.event_id as a, b.event_id as b, a.source as sa, b.source as sb, b.t_us / 1e6 - a.t_us / 1e6 as dt, abs(a.magnitude - b.magnitude) as dm,
least(greatest(50e0 + 10e0 * greatest(a.magnitude, b.magnitude), 50e0), 150e0) as thr, {km("a.latitude", "a.longitude", "b.latitude", "b.longitude")} as km
from catalog a join catalog b on b.t_us between a.t_us and a.t_us + {{most}} and (a.t_us, a.source, a.source_event_id) < (b.t_us, b.source, b.source_event_id)"""
_SCORE = "4e-1 * (1 - dt / 30) + 4e-1 * (1 - km / thr) + 2e-1 * (1 - dm / 15e-1)"


@query(f"with {B.CATALOG}, pair as ({_PAIR.format(most=30000000)}) select a as source_event_id_a, b as source_event_id_b, {round6(_SCORE)} as score from pair where sa <> sb and dm <= 15e-1 and km <= thr")
def candidate_pairs(spark, d):
    return dedup.candidate_pairs(catalog(spark, d)).select("source_event_id_a", "source_event_id_b", r6("score"))


_STRATUM = """concat_ws('|', case when sa = sb then 'same_source' else 'cross_source' end, case when dt <= 1 then 't00_01' when dt <= 5 then 't01_05' when dt <= 15 then 't05_15' when dt <= 30 then 't15_30' else 't30_60' end,
case when km / thr <= 5e-1 then 'd00_050' when km / thr <= 1 then 'd050_100' when km / thr <= 125e-2 then 'd100_125' else 'd125_200' end, case when dm <= 25e-2 then 'm00_025' when dm <= 75e-2 then 'm025_075' when dm <= 15e-1 then 'm075_150' else 'm150_300' end)"""
_REVIEW = f"with {B.CATALOG}, pair as ({_PAIR.format(most=60000000)}), rev as (select *, {_STRATUM} as stratum, case when sa <> sb and dt <= 30 and dm <= 15e-1 and km <= thr then 'match' else 'non_match' end as predicted_label from pair where dm <= 3 and km <= 300 and km / thr <= 2)"


@query(f"{_REVIEW} select stratum, predicted_label, count(*) as n from rev group by all")
def review_strata(spark, d):
    return review.review_pairs(catalog(spark, d)).groupBy("stratum", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_REVIEW} select stratum, a, b, n as stratum_population, least(n, 20) as stratum_sample_size, {round6("n / cast(least(n, 20) as double)")} as review_weight
from (select *, count(*) over (partition by stratum) as n, row_number() over (partition by stratum order by md5('20261025|' || a || '|' || b), a, b) as k from rev) where k <= 20""")
def review_sample(spark, d):
    return review.sampled_pairs(catalog(spark, d)).select("stratum", "a", "b", "stratum_population", "stratum_sample_size", r6("review_weight"))


_LABELLED = "labelled as (select case when o_orderkey % 3 = 0 then 'Match ' else 'non_match' end as p, case when o_custkey % 2 = 0 then 'match' else 'non_match' end as y, cast(o_orderkey % 4 + 1 as double) as w from orders)"


@query(f"""with {_LABELLED}, s as (select sum(w) filter (p = 'Match ' and y = 'match') as tp, sum(w) filter (p = 'Match ' and y <> 'match') as fp, sum(w) filter (p <> 'Match ' and y = 'match') as fn from labelled),
r as (select *, tp / (tp + fp) as precision, tp / (tp + fn) as recall from s) select tp, fp, fn, {round6("precision")} as precision, {round6("recall")} as recall, {round6("2 * precision * recall / (precision + recall)")} as f1 from r""")
def review_scores(spark, d):
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "Match ").otherwise("non_match").alias("predicted_label"), F.when(F.col("o_custkey") % 2 == 0, "match").otherwise("non_match").alias("reviewer_label"), (F.col("o_orderkey") % 4 + 1).alias("review_weight"))
    return review.score_reviews(o).select("tp", "fp", "fn", r6("precision"), r6("recall"), r6("f1"))


_CLUSTERED = f"{B.CATALOG}, {_GROUPS.format(gap=30000000)}, clustered as (select c.*, window_group as cluster_id from catalog c join grp using (event_id))"


def clustered(spark, d):
    c = catalog(spark, d)
    return c.join(windows.sessionize(c.select("event_id", "t_sec"), "event_id", "t_sec", 30.0, name="cluster_id").select("event_id", "cluster_id"), "event_id")


@query(f"""with {_CLUSTERED}, worst as (select a.cluster_id, max(abs(a.t_us - b.t_us)) / 1e6 as dt, max({km("a.latitude", "a.longitude", "b.latitude", "b.longitude")}) as km, max(abs(a.magnitude - b.magnitude)) as dm, max(greatest(a.magnitude, b.magnitude)) as top
from clustered a join clustered b on a.cluster_id = b.cluster_id and a.event_id < b.event_id group by all)
select cluster_id, n as cluster_size, coalesce({round6("dt", 2)}, 0) as cluster_max_time_diff_sec, coalesce({round6("km", 2)}, 0) as cluster_max_distance_km, coalesce({round6("dm", 2)}, 0) as cluster_max_magnitude_diff,
case when n > 1 then {round6("greatest(4e-1 * (1 - least(dt / 30, 1)) + 4e-1 * (1 - least(km / least(greatest(50 + 10 * top, 50), 150), 1)) + 2e-1 * (1 - least(dm / 15e-1, 1)), 0)", 3)} else 1 end as dedup_confidence
from (select cluster_id, count(*) as n from clustered group by all) left join worst using (cluster_id)""")
def cluster_quality(spark, d):
    return dedup.quality(clustered(spark, d))


@query(f"""with {_CLUSTERED}, o as (select *, row_number() over (partition by cluster_id order by case source when 'usgs' then 0 when 'isc' then 1 else 2 end, t_us, source_event_id) as k from clustered)
select cluster_id, max(case when k = 1 then source_event_id end) as source_event_id, {round6("max(case when k = 1 then magnitude end)")} as magnitude, first(mt order by k) filter (mt is not null) as mag_type,
string_agg(distinct source, ',' order by source) as reported_by, {round6("coalesce(stddev_samp(magnitude), 0)")} as magnitude_agreement_std, count(magnitude) as magnitude_report_count from (select *, nullif(mag_type, 'mb') as mt from o) group by cluster_id""")
def representatives(spark, d):
    c = clustered(spark, d).withColumn("mag_type", F.when(F.col("mag_type") != "mb", F.col("mag_type")))
    return dedup.representatives(c, ["source_event_id", "magnitude", "mag_type"]).select("cluster_id", "source_event_id", r6("magnitude"), "mag_type", "reported_by", r6("magnitude_agreement_std"), "magnitude_report_count")


@query()
def dedup_catalog(spark, d):
    return dedup.deduplicate(catalog(spark, d))[0].select("source_event_id", "reported_by", "cluster_size", "dedup_confidence", "magnitude")


@query()
def dedup_id_map(spark, d):
    return dedup.deduplicate(catalog(spark, d))[1]


_IDS = "id_map as (select cast(o_orderkey as varchar) as source_event_id, cast(o_custkey as varchar) as representative_event_id, o_totalprice as ord from orders where o_orderkey % 2 = 0)"


def id_map(spark, d):
    return table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("source_event_id"), F.col("o_custkey").cast("string").alias("representative_event_id"), F.col("o_totalprice").alias("ord"))


@query(f"with {B.FEATURES}, {_IDS} select file, coalesce(representative_event_id, event_id) as event_id from features left join id_map on event_id = source_event_id")
def id_remap(spark, d):
    return joins.remap(features(spark, d), joins.id_lookup(id_map(spark, d), F.col("ord"))).select("file", "event_id")


@query(f"""with {B.FEATURES}, {_IDS}, r as (select file, event_id as o, coalesce(representative_event_id, event_id) as event_id, station, pga_g from features left join id_map on event_id = source_event_id)
select event_id, station, file from (select *, row_number() over (partition by event_id, station order by o <> event_id, file) as k from r) where k = 1""")
def collapse_duplicates(spark, d):
    f = features(spark, d).withColumn("original", F.col("event_id"))
    mapped = joins.remap(f, joins.id_lookup(id_map(spark, d), F.col("ord")))
    return joins.collapse_duplicates(mapped, "original", "file").select("event_id", "station", "file")


@query("""select l_orderkey, first(l_partkey order by abs(l_quantity - 25), l_linenumber, l_partkey) as event from lineitem group by all""")
def best_candidate(spark, d):
    x = table(spark, d, "lineitem").withColumn("wanted", F.lit(25.0))
    return joins.best_candidate(x, "l_orderkey", "l_partkey", "wanted", "l_quantity", "l_linenumber").withColumnRenamed("l_partkey", "event")


# --- facts ---
_FACTS = f"""{B.CATALOG}, {B.STATIONS}, {B.FEATURES}, j as (select f.*, c.magnitude, c.mag_type, c.t_us, c.depth_km, c.latitude as event_latitude, c.longitude as event_longitude, s.latitude as station_latitude, s.longitude as station_longitude, s.vs30_ms,
{round6(km("c.latitude", "c.longitude", "s.latitude", "s.longitude"), 2)} as epicentral_distance_km from features f join catalog c using (event_id) left join stations s using (station)),
facts as (select *, {round6("sqrt(epicentral_distance_km * epicentral_distance_km + depth_km * depth_km)", 2)} as hypocentral_distance_km from j)"""


def event_station(spark, d):
    c = catalog(spark, d).select("event_id", "magnitude", "mag_type", "time_utc", "t_sec", "depth_km", F.col("latitude").alias("event_latitude"), F.col("longitude").alias("event_longitude"))
    s = stations(spark, d).select("station", F.col("latitude").alias("station_latitude"), F.col("longitude").alias("station_longitude"), "vs30_ms")
    return facts.join_distances(features(spark, d), c, s)


@query(f"with {_FACTS} select file, event_id, station, epicentral_distance_km, hypocentral_distance_km from facts")
def event_station_facts(spark, d):
    return event_station(spark, d).select("file", "event_id", "station", "epicentral_distance_km", "hypocentral_distance_km")


@query(f"""with {B.FEATURES} select event_id, count(*) as num_waveform_files, {round6("coalesce(max(pga_g) filter (usable_for_engineering), max(pga_g))")} as max_pga_g, {round6("coalesce(max(pgv_cms) filter (usable_for_engineering), max(pgv_cms))")} as max_pgv_cms,
count(*) filter (usable_for_engineering and pga_g is not null) > 0 as pga_from_strong_motion, {round6("max(snr_db)")} as best_snr_db, bool_or(p_pick_time is not null) as has_phase_pick from features group by all""")
def event_aggregates(spark, d):
    a = facts.event_aggregates(features(spark, d))
    a = a.withColumn("max_pga_g", F.coalesce("eng_pga_g", "any_pga_g")).withColumn("max_pgv_cms", F.coalesce("eng_pgv_cms", "any_pgv_cms")).withColumn("pga_from_strong_motion", F.col("eng_pga_g").isNotNull())
    return a.select("event_id", "num_waveform_files", r6("max_pga_g"), r6("max_pgv_cms"), "pga_from_strong_motion", r6("best_snr_db"), "has_phase_pick")


@query(f"""{_NEAREST}, {B.FEATURES}, agg as (select event_id, count(*) as n, coalesce(max(pga_g) filter (usable_for_engineering), max(pga_g)) as pga, bool_or(p_pick_time is not null) as pick from features group by all)
select c.event_id, {round6(B.MW)} as mw_estimate, any_one.b[2] as nearest_station, coalesce(n, 0) as num_waveform_files, coalesce(n, 0) > 0 as has_waveform, {round6("pga")} as max_pga_g, coalesce(pick, false) as has_phase_pick
from catalog c join any_one on c.latitude = la and c.longitude = lo left join agg on agg.event_id = c.event_id""")
def event_dataset(spark, d):
    return facts.event_dataset(catalog(spark, d), stations(spark, d), features(spark, d)).select("event_id", r6("mw_estimate"), "nearest_station", "num_waveform_files", "has_waveform", r6("max_pga_g"), "has_phase_pick")


# --- splits ---
_FRACTION = "('0x' || substr(md5({k}), 1, 8))::bigint / 4294967295e0"
_SPLIT = "case when {f} < 7e-1 then 'train' when {f} < 7e-1 + 15e-2 then 'val' else 'test' end"


@query(f"with {B.CATALOG} select event_id, {_SPLIT.format(f=_FRACTION.format(k='event_id'))} as split from catalog")
def hash_split(spark, d):
    return catalog(spark, d).select("event_id", splits.hash_split(F.col("event_id")).alias("split"))


@query(f"""with {B.FEATURES}, c as (select station, count(*) as n from features group by all), o as (select *, (sum(n) over (order by md5('station_' || station) rows unbounded preceding) - n / 2e0) / sum(n) over () as mid from c)
select station, n, {_SPLIT.format(f="mid")} as split from o""")
def station_split(spark, d):
    return splits.station_split(features(spark, d))


@query("select event_id, case when ts < timestamp '2024-01-15' then 'train' else 'test' end as split from events")
def time_split(spark, d):
    return table(spark, d, "events").select("event_id", splits.time_split(F.col("ts").cast("timestamp"), "2024-01-15").alias("split"))


@query(f"""with {_FACTS}, {_GROUPS.format(gap=210000000).replace('from catalog', 'from (select * from catalog where event_id in (select event_id from facts))')}, other as (select a.event_id, max(b.magnitude) as m from catalog a join catalog b on b.t_us between a.t_us - 130000000 and a.t_us + 200000000 and a.event_id <> b.event_id group by all)
select f.event_id, file, {round6("pga_g")} as pga_g, hypocentral_distance_km, {_SPLIT.format(f=_FRACTION.format(k='window_group'))} as split from facts f join grp using (event_id) left join other o on o.event_id = f.event_id
where usable_for_engineering and not coalesce(m >= magnitude, false) and hypocentral_distance_km is not null and pga_g is not null""")
def ground_motion_task(spark, d):
    rows = windows.window_context(event_station(spark, d), catalog(spark, d))
    return splits.ground_motion_task(rows, ["event_id", "file", "pga_g", "hypocentral_distance_km"], ["no_such_column"]).withColumn("pga_g", S.np_round(F.col("pga_g"), 6))


@query(f"with {B.FEATURES} select event_id, station, file, p_pick_time, s_pick_time, {_SPLIT.format(f=_FRACTION.format(k='event_id'))} as split from features where usable_for_phase_picking and p_pick_time is not null")
def phase_picking_task(spark, d):
    return splits.phase_picking_task(features(spark, d))


@query(f"""with {_FACTS} select event_id, station, file, p_pick_time, {round6("magnitude")} as magnitude, mag_type, {round6(B.MW)} as mw_estimate, epicentral_distance_km, hypocentral_distance_km, '1,3,5,10' as available_windows_sec, {_SPLIT.format(f=_FRACTION.format(k='event_id'))} as split
from facts where {B.MW} is not null and p_pick_time is not null and duration_sec >= 10""")
def early_warning_task(spark, d):
    out = splits.early_warning_task(facts.with_magnitudes(event_station(spark, d)))
    return out.withColumn("magnitude", S.np_round(F.col("magnitude"), 6)).withColumn("mw_estimate", S.np_round(F.col("mw_estimate"), 6))


# --- waveforms ---
_CLIPPED = "coalesce(len(samples) >= 10 and {top} > 0 and len(list_filter(samples, lambda x: abs(x) >= {top} * 999e-3)) > greatest(5, len(samples) * 1e-2), false)"


@query(f"with {B.TRACES} select file, channel, {round6('list_max(list_transform(samples, lambda x: abs(x))) / 981e-2', 5)} as peak, clipped(samples, top) as clipped, clipped(samples, top * 5e-1) as clipped_at_half from (select *, list_max(list_transform(samples, lambda x: abs(x))) as top from traces)".replace(
    "clipped(samples, top)", _CLIPPED.format(top="top")).replace("clipped(samples, top * 5e-1)", _CLIPPED.format(top="top * 5e-1")))
def trace_peaks(spark, d):
    half = F.col("top") * 0.5
    limited = F.transform("samples", lambda x: F.least(F.greatest(x, -half), half))
    t = traces(spark, d).withColumn("top", waveform.peak(F.col("samples")))
    return t.select("file", "channel", S.np_round(F.col("top") / S.GRAVITY, 5).alias("peak"), waveform.clipped(F.col("samples")).alias("clipped"), waveform.clipped(limited).alias("clipped_at_half"))


@query(f"""with {B.TRACES}, x as (select file, channel, i, samples[i] as a, sum(samples[i] * samples[i]) over (partition by file, channel order by i) as e, sum(samples[i] * samples[i]) over (partition by file, channel) as t from traces, unnest(range(1, 65)) as u(i))
select file, channel, {round6("max(t) * pi() / (2 * 981e-2) * 1e-2", 4)} as arias, {round6("sum(abs(a)) * 1e-2", 4)} as cav, {round6("(count(*) filter (e / t < 95e-2) - count(*) filter (e / t < 5e-2)) * 1e-2", 3)} as d5_95 from x group by all""")
def intensity(spark, d):
    s, dt = F.col("samples"), F.lit(1.0) / F.col("sampling_rate_hz")
    return traces(spark, d).select("file", "channel", S.np_round(waveform.arias(s, dt), 4).alias("arias"), waveform.cav(s, dt).alias("cav"), waveform.significant_duration(s, dt).alias("d5_95"))


@query(f"""with {B.TRACES}, h as (select e.file, e.samples[3:64] as h1, n.samples[1:62] as h2 from traces e join traces n on e.file = n.file and e.channel = 'HNE' and n.channel = 'HNN'),
p as (select file, dg, max(abs(h1[i] * cos(radians(dg)) + h2[i] * sin(radians(dg)))) as m from h, unnest(range(0, 180)) as u(dg), unnest(range(1, 63)) as w(i) group by all),
pk as (select file, max(list_max(list_transform(samples, lambda x: abs(x)))) filter (channel = 'HNE') as h1, max(list_max(list_transform(samples, lambda x: abs(x)))) filter (channel = 'HNN') as h2, max(list_max(list_transform(samples, lambda x: abs(x)))) filter (channel = 'HNZ') as v from traces group by all)
select file, {round6("h1", 5)} as h1, {round6("h2", 5)} as h2, {round6("v", 5)} as v, {round6("sqrt(h1 * h2)", 5)} as geomean, {round6("median(m)", 5)} as rotd50 from pk join p using (file) group by file, h1, h2, v""")
def horizontal_peaks(spark, d):
    out = waveform.horizontal_peaks(traces(spark, d)).where("rotd50 is not null")
    return out.select("file", *(S.np_round(F.col(c), 5).alias(c) for c in ("h1", "h2", "v", "geomean", "rotd50")))


@query("select cast(vec_id // 3 as varchar) as file, case vec_id % 3 when 0 then 'HNE' when 1 then 'HNN' else 'HNZ' end as channel, 2 as pieces, cast(vec_id % 4 > 0 as int) as gaps, vec_id % 4 / 1e2 as missing_sec from embeddings")
def trace_gaps(spark, d):
    """Each trace is two pieces, with none to three samples missing between them."""
    v, t = F.col("vec_id"), table(spark, d, "embeddings")
    channel = F.when(v % 3 == 0, "HNE").when(v % 3 == 1, "HNN").otherwise("HNZ")
    pieces = F.explode(F.array(*(F.struct(F.timestamp_micros(F.lit(1_600_000_000_000_000) + at).alias("start_ts"), F.slice(F.col("embedding").cast("array<double>"), start, n).alias("samples")) for at, start, n in ((F.lit(0), 1, 20), ((v % 4 + 20) * 10_000, 21, 44))))).alias("p")
    return waveform.gap_stats(t.select(F.call_function("div", v, F.lit(3)).cast("string").alias("file"), channel.alias("channel"), F.lit(100.0).alias("sampling_rate_hz"), pieces).select("file", "channel", "sampling_rate_hz", "p.*"))


@query()
def response_spectra(spark, d):
    pairs = waveform.aligned_horizontals(traces(spark, d))
    schema = "file string, " + ", ".join(f"sa_{i} double" for i in range(len(K.PERIODS)))
    return waveform.map_arrays(pairs.select("file", "h1", "h2", "dt"), schema, lambda r: {"file": r["file"]} | {f"sa_{i}": K.sa_rotd50(r["h1"], r["h2"], r["dt"], p) for i, p in enumerate(K.PERIODS)})


@query()
def spectra(spark, d):
    def one(r):
        dominant, mean = K.spectrum(r["samples"], 1 / r["sampling_rate_hz"])
        return {"file": r["file"], "channel": r["channel"], "dominant_hz": dominant, "mean_hz": mean}

    return waveform.map_arrays(traces(spark, d).select("file", "channel", "sampling_rate_hz", "samples"), "file string, channel string, dominant_hz double, mean_hz double", one)


@query()
def waveform_features(spark, d):
    return waveform.compute_features(traces(spark, d))


@query()
def p_window_amplitudes(spark, d):
    t = traces(spark, d)
    return waveform.p_windows(t, t.select("file").distinct().withColumn("p_pick_sec", F.lit(0.1)))


# --- models and scores ---
_LN = "3.26685e0 + case when m <= 675e-2 then 29e-4 * (m - 675e-2) else -5096e-4 * (m - 675e-2) end + -4846e-5 * pow(85e-1 - m, 2) + (-147905e-5 + 2529e-4 * (m - 675e-2)) * ln(sqrt(r * r + 5625e-2))"
_GMPE = f"""{_FACTS}, g0 as (select file, event_id, magnitude as m, greatest(hypocentral_distance_km, 1) as r, vs30_ms as v30, pga_g from facts where vs30_ms is not null), g1 as (select *, {_LN} as lr, least(v30, 1000) / 750e0 as v from g0),
g2 as (select *, exp(lr + -41997e-5 * ln(v) + case when v30 < 750 then -28846e-5 * ln((exp(lr) + 25e-1 * pow(v, 32e-1)) / ((exp(lr) + 25e-1) * pow(v, 32e-1))) else 0 end) as pred from g1)"""


def with_model(spark, d):
    f = event_station(spark, d).where("vs30_ms is not null").withColumn("r", F.greatest("hypocentral_distance_km", F.lit(1.0)))
    return f.withColumn("pred", gmpe.median_pga(F.col("magnitude"), F.col("r"), F.col("vs30_ms")))


@query(f"with {_GMPE} select file, {round6('log10(pred)')} as log_pga, {round6('log10(pga_g) - log10(pred)')} as residual from g2")
def gmpe_residuals(spark, d):
    f = with_model(spark, d).withColumn("log_pga", F.log10("pred")).withColumn("residual", gmpe.log_residual(F.col("pga_g"), F.col("pred")))
    return f.select("file", r6("log_pga"), r6("residual"))


@query(f"""with {_GMPE}, b as (select *, case when r >= 0 and r <= 200 then '(0, 200]' when r > 200 and r <= 400 then '(200, 400]' when r > 400 and r <= 1000 then '(400, 1000]' end as bin, log10(pga_g) - log10(pred) as res from g2)
select bin, count(*) as n, count(distinct event_id) as n_events, {round6("avg(res)")} as bias, {round6("stddev_pop(res)")} as std from b group by all""")
def gmpe_bins(spark, d):
    f = with_model(spark, d).withColumn("res", gmpe.log_residual(F.col("pga_g"), F.col("pred"))).withColumn("bin", stats.binned(F.col("r"), [0, 200, 400, 1000]))
    return f.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"), F.avg("res").alias("bias"), F.stddev_pop("res").alias("std")).select("bin", "n", "n_events", r6("bias"), r6("std"))


@query(f"""with {_GMPE}, s as (select log10(pga_g) as y, log10(pga_g) - log10(pred) as r from g2) select count(*) as n, {round6("sqrt(avg(r * r))")} as rmse, {round6("avg(abs(r))")} as mae, {round6("avg(r)")} as bias, {round6("stddev_pop(r)")} as std,
{round6("1 - sum(r * r) / (var_pop(y) * count(*))")} as r2, {round6("stddev_pop(y)")} as naive_rmse from s""")
def regression_scores(spark, d):
    s = stats.regression_scores(with_model(spark, d), F.log10("pga_g"), F.log10("pred"))
    return s.select("n", *(r6(c) for c in ("rmse", "mae", "bias", "std", "r2", "naive_rmse")))


@query(f"""select {round6("regr_slope(l_extendedprice / 1e5, l_quantity)")} as slope, {round6("regr_intercept(l_extendedprice / 1e5, l_quantity)")} as intercept from lineitem""")
def ols_one_feature(spark, d):
    k = stats.ols(table(spark, d, "lineitem"), F.col("l_extendedprice") / 1e5, [F.col("l_quantity")])
    return spark.createDataFrame([(round(float(k[0]), 6), round(float(k[1]), 6))], "slope double, intercept double")


def _linear(train: str = "true") -> str:
    """k1, k2, k3 and the intercept k0 of ``o`` (y, x1, x2, x3) by Cramer's rule on covariances, as table ``k``."""
    return f"""c as (select avg(y) as ym, avg(x1) as m1, avg(x2) as m2, avg(x3) as m3, covar_pop(x1, x1) as s11, covar_pop(x1, x2) as s12, covar_pop(x1, x3) as s13, covar_pop(x2, x2) as s22, covar_pop(x2, x3) as s23, covar_pop(x3, x3) as s33,
covar_pop(x1, y) as b1, covar_pop(x2, y) as b2, covar_pop(x3, y) as b3 from o where {train}),
k3 as (select *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13) as det, b1 * (s22 * s33 - s23 * s23) - s12 * (b2 * s33 - s23 * b3) + s13 * (b2 * s23 - s22 * b3) as d1,
s11 * (b2 * s33 - s23 * b3) - b1 * (s12 * s33 - s23 * s13) + s13 * (s12 * b3 - b2 * s13) as d2, s11 * (s22 * b3 - b2 * s23) - s12 * (s12 * b3 - b2 * s13) + b1 * (s12 * s23 - s22 * s13) as d3 from c),
k as (select ym, d1 / det as k1, d2 / det as k2, d3 / det as k3, ym - m1 * d1 / det - m2 * d2 / det - m3 * d3 / det as k0 from k3)"""


@query(f"""with {_GMPE}, o as (select log10(pga_g) as y, m as x1, log10(r) as x2, log10(v30) as x3 from g2), {_linear()}, s as (select y, y - (k0 + k1 * x1 + k2 * x2 + k3 * x3) as r from o, k)
select count(*) as n, {round6("sqrt(avg(r * r))")} as rmse, {round6("avg(abs(r))")} as mae, {round6("avg(r)")} + 0 as bias, {round6("stddev_pop(r)")} as std, {round6("1 - sum(r * r) / (var_pop(y) * count(*))")} as r2, {round6("stddev_pop(y)")} as naive_rmse from s""")
def ols_three_features(spark, d):
    f = with_model(spark, d)
    x = [F.col("magnitude"), F.log10("r"), F.log10("vs30_ms")]
    k = stats.ols(f, F.log10("pga_g"), x)
    s = stats.regression_scores(f, F.log10("pga_g"), stats.predict(k, x))
    return s.select("n", *((S.np_round(F.col(c), 6) + 0.0).alias(c) for c in ("rmse", "mae", "bias", "std", "r2", "naive_rmse")))


@query()
def bootstrap_intervals(spark, d):
    f = with_model(spark, d).withColumn("y", F.log10("pga_g")).withColumn("res", gmpe.log_residual(F.col("pga_g"), F.col("pred")))
    found = stats.cluster_bootstrap(f, "event_id", "y", "res") or {}
    return spark.createDataFrame([(k, *v) for k, v in found.items()], "metric string, low double, high double")


@query()
def random_forest(spark, d):
    f = with_model(spark, d).select("event_id", "magnitude", "r", "vs30_ms", F.log10("pga_g").alias("y")).withColumn("split", splits.hash_split(F.col("event_id")))
    out, _ = stats.random_forest(f.where("split = 'train'"), f.where("split <> 'train'"), ["magnitude", "r", "vs30_ms"], "y")
    return stats.regression_scores(out, F.col("y"), F.col("prediction"))


_PICKS = "pick as (select l_extendedprice / 1e4 as e, l_discount as c from lineitem)"


@query(f"""with {_PICKS}, mid as (select median(c) as m from pick) select count(e) as n, {round6("avg(e)")} as mean, {round6("median(e)")} as median, {round6("quantile_cont(e, 9e-1)")} as p90, {round6("max(e)")} as max, {round6("avg(cast(e > 1 as int))")} as share_over_1s,
{round6("avg(e) filter (c >= m)")} as mean_high_confidence, {round6("avg(e) filter (c < m)")} as mean_low_confidence from pick, mid""")
def pick_errors(spark, d):
    p = table(spark, d, "lineitem").select((F.col("l_extendedprice") / 1e4).alias("abs_error_sec"), F.col("l_discount").alias("confidence"))
    out = stats.pick_errors(p)
    return out.select("n", *(r6(c) for c in out.columns[1:]))


@query("select count(*) as records, count(distinct l_orderkey) as events, count(distinct l_suppkey) as stations from lineitem")
def record_counts(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("l_orderkey").alias("events"), F.countDistinct("l_suppkey").alias("stations"))


# --- quality ---
def _dataset(spark, d):
    e = facts.with_magnitudes(catalog(spark, d))
    return e.withColumns({
        "has_waveform": F.lit(True), "num_waveform_files": F.col("depth_km").cast("long"), "magnitude_agreement_std": F.col("magnitude") - 4.0,
        "reported_by": F.when(F.col("depth_km") != 7, F.col("source")), "mw_estimate": F.when(F.col("depth_km") == 3, 5.0).otherwise(F.col("mw_estimate")),
    })




def _checks(parts: list[tuple[str, str, str]]) -> str:
    return " union all ".join(f"""select '{n}' as "check", v = 0 as passed, v::bigint as detail from (select {v} as v {f})""" for n, v, f in parts)


_SIZE = " union all ".join(f"""select '{n}_not_empty' as "check", count(*) > 0 as passed, count(*) as detail from {t}""" for n, t in (("events", "catalog"), ("stations", "stations"), ("features", "features")))


@query(f"with {B.CATALOG}, {B.STATIONS}, {B.FEATURES} {_SIZE} union all " + _checks([
    ("event_id_unique", "count(*) - count(distinct event_id)", "from catalog"), ("no_missing_critical", "count_if(magnitude is null or latitude is null or longitude is null or t_us is null)", "from catalog"),
    ("magnitude_range", "count_if(not magnitude between 0 and 10)", "from catalog"), ("inside_region", "count_if(not (latitude between 34 and 44 and longitude between 24 and 46))", "from catalog"),
    ("depth_not_negative", "count_if(depth_km < 0)", "from catalog"), ("waveform_flag_consistent", "count_if(depth_km = 0)", "from catalog"), ("mw_only_for_known_scales", f"count_if(case when depth_km = 3 then 5e0 else {B.MW} end is not null and {B.SCALE} not in ('local_magnitude', 'moment_magnitude'))", "from catalog"),
    ("agreement_not_negative", "count_if(magnitude - 4 < 0)", "from catalog"), ("reported_by_present", "count_if(depth_km = 7)", "from catalog"),
    ("station_coordinates_present", "count_if(latitude is null or longitude is null)", "from stations"), ("vs30_range", "count_if(not vs30_ms between 100 and 2000)", "from stations"), ("site_class_domain", "count_if(nehrp_site_class not in ('A','B','C','D','E'))", "from stations"),
    ("pga_not_negative", "count_if(pga_g < 0)", "from features"), ("one_row_a_file", "count(*) - count(distinct file)", "from features"),
]))
def checks_structural(spark, d):
    return quality.structural(_dataset(spark, d), stations(spark, d), features(spark, d))


@query(f"""with {_FACTS}, moved as (select *, epicentral_distance_km + case when station::int % 9 = 0 then 5e0 else 0e0 end as e from facts) select 'event_station_not_empty' as "check", count(*) > 0 as passed, count(*) as detail from facts union all """ + _checks([
    ("event_station_unique", "count(*) - count(distinct (event_id, station))", "from facts"), ("epicentral_recomputed", f"count_if(not coalesce(abs({km('event_latitude', 'event_longitude', 'station_latitude', 'station_longitude')} - e) <= 1, false))", "from moved"),
    ("hypocentral_not_less", "count_if(not coalesce(hypocentral_distance_km >= e - 1e-2, false))", "from moved"),
]))
def checks_geometry(spark, d):
    moved = F.when(F.col("station").cast("int") % 9 == 0, 5.0).otherwise(0.0)
    return quality.geometry(event_station(spark, d).withColumn("epicentral_distance_km", F.col("epicentral_distance_km") + moved))


_BROKEN = """x as (select * replace (case when duration_sec = 1 then 0e0 else highpass_corner_hz end as highpass_corner_hz, case when duration_sec = 2 then 'broadband' else instrument_type_used end as instrument_type_used,
case when duration_sec = 3 then pga_h1_g * 15e-1 else pga_geomean_g end as pga_geomean_g, case when duration_sec = 4 then 9e0 else pga_rotd50_g end as pga_rotd50_g, case when duration_sec = 5 then pga_g * 8 else pga_g end as pga_g,
case when duration_sec = 6 then pgv_cms * 1000 else pgv_cms end as pgv_cms, case when duration_sec = 7 then p_pick_time - 1 else s_pick_time end as s_pick_time) from features)"""


def broken_features(spark, d):
    """Features that break each rule now and then."""
    c, at = F.col, lambda n, value, name: F.when(F.col("duration_sec") == n, value).otherwise(F.col(name)).alias(name)
    return features(spark, d).withColumns({
        "highpass_corner_hz": at(1, F.lit(0.0), "highpass_corner_hz"), "instrument_type_used": at(2, F.lit("broadband"), "instrument_type_used"), "pga_geomean_g": at(3, c("pga_h1_g") * 1.5, "pga_geomean_g"),
        "pga_rotd50_g": at(4, F.lit(9.0), "pga_rotd50_g"), "pga_g": at(5, c("pga_g") * 8, "pga_g"), "pgv_cms": at(6, c("pgv_cms") * 1000, "pgv_cms"), "s_pick_time": at(7, c("p_pick_time") - 1, "s_pick_time"),
    })


@query(f"with {B.FEATURES}, {_BROKEN} " + _checks([
    ("pga_below_4g", "count_if(pga_g > 4)", "from x"), ("pgv_below_500", "count_if(pgv_cms > 500)", "from x"), ("corner_recorded", "count_if(pga_g is not null and not coalesce(highpass_corner_hz > 0, false))", "from x"),
    ("engineering_is_strong_motion", "count_if(usable_for_engineering and instrument_type_used <> 'strong_motion')", "from x"),
    ("geomean_between", "count_if(not (pga_geomean_g between least(pga_h1_g, pga_h2_g) - 2e-5 and greatest(pga_h1_g, pga_h2_g) + 2e-5))", "from x"),
    ("rotd50_bounded", "count_if(not (pga_rotd50_g between 0 and sqrt(pga_h1_g * pga_h1_g + pga_h2_g * pga_h2_g) + 2e-5))", "from x"),
    ("pga_is_largest_component", "count_if(abs(pga_g - greatest(pga_h1_g, pga_h2_g, pga_v_g)) > 2e-5)", "from x"), ("s_after_p", "count_if(s_pick_time <= p_pick_time)", "from x"),
]))
def checks_features(spark, d):
    f = broken_features(spark, d)
    return quality.union_all([quality.plausibility(f), quality.horizontal(f), quality.phase_order(f)])


@query(f"""with {B.CATALOG}, {_GROUPS.format(gap=210000000)}, s as (select event_id, window_group, {_SPLIT.format(f=_FRACTION.format(k='event_id'))} as split from grp),
b as (select window_group, count(distinct split) as n from s group by all) select 'leakage_event_split' as "check", count_if(n > 1) = 0 as passed, count_if(n > 1)::bigint as detail from b""")
def checks_leakage(spark, d):
    g = windows.sessionize(catalog(spark, d).select("event_id", "t_sec"), "event_id", "t_sec")
    return quality.leakage(g, g.select(F.lit("event_split").alias("task"), splits.hash_split(F.col("event_id")).alias("split"), "event_id"))


@query(f"""with {B.FEATURES}, c as (select station, count(*) as n from features group by all), o as (select *, (sum(n) over (order by md5('station_' || station) rows unbounded preceding) - n / 2e0) / sum(n) over () as mid from c),
s as (select case when duration_sec = 1 then null else station end as station, case when duration_sec = 2 and station::int % 5 = 0 then 'test' else {_SPLIT.format(f="mid")} end as split from features join o using (station)),
shared as (select station, count(distinct split) as k from s where station is not null group by all), t as (select ts, case when ts < timestamp '2024-01-15' then 'train' else 'test' end as split from events) """ + _checks([
    ("station_disjoint", "count_if(k > 1)", "from shared"), ("station_present", "count_if(station is null)", "from s"), ("splits_not_empty", "3 - count(distinct split)", "from s"),
    ("train_before_cutoff", "count_if(split = 'train' and ts >= timestamp '2024-01-10')", "from t"), ("test_from_cutoff", "count_if(split = 'test' and ts < timestamp '2024-01-10')", "from t"),
]))
def checks_holdouts(spark, d):
    f = features(spark, d)
    moved = F.when((F.col("duration_sec") == 2) & (F.col("station").cast("int") % 5 == 0), "test").otherwise(F.col("split"))
    by_station = f.join(splits.station_split(f).select("station", "split"), "station").select(F.when(F.col("duration_sec") != 1, F.col("station")).alias("station"), moved.alias("split"))
    by_time = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("time_utc"), splits.time_split(F.col("ts").cast("timestamp"), "2024-01-15").alias("split"))
    return quality.station_holdout(by_station).unionByName(quality.time_holdout(by_time, "2024-01-10"))


@query(f"""with {B.LOG}, {B.FEATURES} select 'log_matches_files' as "check", a = b as passed, abs(a - b)::bigint as detail from (select count_if(status = 'ok') as a from fetch_log), (select count(*) as b from features)""")
def checks_fetch_log(spark, d):
    ok = fetch_log(spark, d).agg(F.count_if(F.col("status") == "ok").alias("n"))
    return quality.count_matches(ok, features(spark, d).agg(F.count(F.lit(1)).alias("n")), "log_matches_files")


@query()
def checks_dedup(spark, d):
    return quality.dedup_quality(stored(dedup.deduplicate(catalog(spark, d))[0].select("cluster_size", "dedup_confidence")))


# --- provenance, set operations ---
@query("""with o as (select cast(p_partkey as varchar) as path, p_brand as h from part where p_partkey % 5 <> 0), n as (select cast(p_partkey as varchar) as path, case when p_size = 1 then 'new' else p_brand end as h from part where p_partkey % 7 <> 0)
select path, change from (select coalesce(o.path, n.path) as path, case when o.path is null then 'added' when n.path is null then 'removed' when o.h <> n.h then 'changed' end as change from o full join n on o.path = n.path) where change is not null""")
def manifest_diff(spark, d):
    from faultline.operators import provenance

    p = table(spark, d, "part")
    name = F.col("p_partkey").cast("string").alias("path")
    return provenance.diff_artifacts(p.where("p_partkey % 5 <> 0").select(name, F.col("p_brand").alias("sha256")), p.where("p_partkey % 7 <> 0").select(name, F.when(F.col("p_size") == 1, "new").otherwise(F.col("p_brand")).alias("sha256")))


@query(f"""with {B.CATALOG}, {B.STATIONS} select source, 'reports' as metric, count(*) as value from catalog group by all union all select 'stations', 'rows', count(*) from stations union all select 'stations', 'with_vs30', count(vs30_ms) from stations""")
def lineage_counts(spark, d):
    from faultline.operators import provenance

    return provenance.lineage_counts(catalog(spark, d), stations(spark, d))


@query("""select 'a' as side, c_custkey as k, c_acctbal as bal, null::varchar as name from customer union all select 'b', s_suppkey, null, s_name from supplier""")
def union_mismatched(spark, d):
    a = table(spark, d, "customer").select(F.lit("a").alias("side"), F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    b = table(spark, d, "supplier").select(F.lit("b").alias("side"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)""")
def resume_anti_join(spark, d):
    done = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("""select *, row_number() over (order by n desc, event_type) as rank from (select event_type, count(*) as n from events group by all)""")
def value_counts(spark, d):
    c = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "event_type")))


@query("""select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber limit 10""")
def largest_records(spark, d):
    return table(spark, d, "lineitem").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10).select("l_orderkey", "l_linenumber", "l_extendedprice")


# --- scans with coercion, streaming twins run on a batch ---
@query(f"""with {B.CATALOG}, {_GROUPS.format(gap=210000000)} select window_group, count(*) as n from grp group by all""")
def session_window_groups(spark, d):
    from faultline.streaming import streams

    return streams.session_groups(catalog(spark, d)).select("window_group", "n")


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then cast(o_custkey as double) end as coerced, case when o_totalprice between 1000 and 100000 then o_totalprice end as price from orders""")
def strict_coercion(spark, d):
    from faultline.sources import tables

    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))).otherwise(F.col("o_orderpriority")).alias("coerced"), F.col("o_totalprice").alias("price"))
    return tables.strict(o, {"coerced": "double", "price": "double"}, {"price": (1000.0, 100000.0)})


@query("""select 'train' as split, cast(l_orderkey as varchar) as k, cast(null as varchar) as note from lineitem where l_orderkey % 2 = 0 union all select 'test', cast(l_orderkey as varchar), l_returnflag from lineitem where l_orderkey % 2 = 1""")
def aligned_splits(spark, d):
    from faultline.sources import tables

    x = table(spark, d, "lineitem")
    train = x.where("l_orderkey % 2 = 0").select(F.col("l_orderkey").cast("string").alias("k"), F.lit(None).cast("double").alias("note"))
    test = x.where("l_orderkey % 2 = 1").select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_returnflag").alias("note"))
    out = tables.aligned({"train": train, "test": test})
    return quality.union_all([df.withColumn("split", F.lit(n)) for n, df in out.items()])


@query("""select s_suppkey as k, s_acctbal as vs30_ms, case when s_acctbal > 0 then case when s_acctbal > 1500 then 'A' when s_acctbal > 760 then 'B' when s_acctbal > 360 then 'C' when s_acctbal > 180 then 'D' else 'E' end end as nehrp_site_class from supplier""")
def site_enrichment(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("vs30_ms"))
    return s.withColumn("nehrp_site_class", S.site_class(F.col("vs30_ms")))


# --- composed reports ---
_SPLIT_FACTS = f"""{_FACTS}, sf as (select *, {_SPLIT.format(f=_FRACTION.format(k='event_id'))} as split from facts)"""
_MATCHED = f"""a as (select cast(l_orderkey as varchar) as event_id, cast(l_suppkey as varchar) as station, epoch_us(l_shipdate) + l_linenumber * 700000 as t from lineitem where l_linenumber % 2 = 1),
pick as (select event_id, station, split, snr_db as c, abs(p_pick_time - t) / 1e6 as e from a join sf using (event_id, station) where p_pick_time is not null)"""


def split_facts(spark, d):
    return event_station(spark, d).withColumn("split", splits.hash_split(F.col("event_id")))


def picks(spark, d):
    x = table(spark, d, "lineitem")
    at = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 700_000)
    analyst = x.select(F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_suppkey").cast("string").alias("station"), F.when(F.col("l_linenumber") % 2 == 1, "P").otherwise("S").alias("phase_type"), at.alias("pick_time"))
    automatic = split_facts(spark, d).withColumn("p_pick_time", F.timestamp_micros("p_pick_time")).withColumn("p_pick_confidence", F.col("snr_db"))
    return reports.matched_picks(analyst, automatic, "P")


@query(f"with {_SPLIT_FACTS}, {_MATCHED} select event_id, station, split, {round6('c')} as confidence, {round6('e')} as abs_error_sec from pick")
def matched_picks(spark, d):
    return picks(spark, d).select("event_id", "station", "split", r6("confidence"), r6("abs_error_sec"))


@query(f"""with {_SPLIT_FACTS}, {_MATCHED}, mid as (select split, median(c) as m from pick group by all) select split, count(e) as n_matched, {round6("avg(e)")} as mean_abs_error_sec, {round6("median(e)")} as median_abs_error_sec,
{round6("quantile_cont(e, 9e-1)")} as p90_abs_error_sec, {round6("max(e)")} as max_abs_error_sec, {round6("avg(cast(e > 1 as int))")} as fraction_over_1s, {round6("avg(e) filter (c >= m)")} as mean_abs_error_high_confidence,
{round6("avg(e) filter (c < m)")} as mean_abs_error_low_confidence, count_if(c >= m) as n_high_confidence, count_if(c < m) as n_low_confidence from pick join mid using (split) group by split""")
def pick_report(spark, d):
    out = reports.pick_report(picks(spark, d))
    return out.select("split", *(c if c.startswith("n_") else r6(c) for c in out.columns[1:]))


@query()
def score_split(spark, d):
    f = split_facts(spark, d)
    return reports.score_split(f.where("split = 'train'"), f.where("split <> 'train'"))


_MODELLED = f"""{_SPLIT_FACTS}, g0 as (select split, event_id, pga_g, hypocentral_distance_km as h, magnitude as m, greatest(hypocentral_distance_km, 1) as r, vs30_ms as v30 from sf where vs30_ms is not null),
g1 as (select *, {_LN} as lr, least(v30, 1000) / 750e0 as v from g0),
g2 as (select *, exp(lr + -41997e-5 * ln(v) + case when v30 < 750 then -28846e-5 * ln((exp(lr) + 25e-1 * pow(v, 32e-1)) / ((exp(lr) + 25e-1) * pow(v, 32e-1))) else 0 end) as pred from g1)"""


def modelled(spark, d):
    return with_model(spark, d).withColumn("split", splits.hash_split(F.col("event_id")))


@query(f"""with {_MODELLED}, s as (select split, event_id, h, log10(pga_g) - log10(pred) as r from g2), w as (select 'all' as grouping, split as value, * from s union all select 'within_200_km', split, * from s where h <= 200)
select grouping, value, count(*) as n, count(distinct event_id) as n_events, {round6("sqrt(avg(r * r))")} as rmse, {round6("avg(r)")} as bias, {round6("stddev_pop(r)")} as std from w group by grouping, value""".replace("grouping", '"grouping"'))
def model_report(spark, d):
    f = modelled(spark, d)
    return reports.model_report(f, gmpe.log_residual(F.col("pga_g"), F.col("pred"))).select("grouping", "value", "n", "n_events", r6("rmse"), r6("bias"), r6("std"))


@query(f"""with {_MODELLED}, o as (select split, log10(pga_g) as y, log10(pga_g) - log10(pred) as r, m as x1, log10(h) as x2, log10(v30) as x3 from g2 where pga_g > 0), {_linear("split = 'train'")},
t as (select r, y - (k0 + k1 * x1 + k2 * x2 + k3 * x3) as s from o, k where split <> 'train') select count(*) as n, {round6("sqrt(avg(r * r))")} as model_rmse, {round6("stddev_pop(r)")} as unbiased_rmse, {round6("sqrt(avg(s * s))")} as linear_rmse from t""")
def model_comparison(spark, d):
    f = modelled(spark, d)
    return reports.model_comparison(f.where("split = 'train'"), f.where("split <> 'train'"), F.log10("pred")).select("n", r6("model_rmse"), r6("unbiased_rmse"), r6("linear_rmse"))


@query(f"""with {B.CATALOG}, {B.STATIONS}, began as (select *, case when station::int % 5 > 0 then epoch_us(timestamp '2024-01-01') + (station::int % 30) * 86400000000 end as since from stations where has_strong_motion),
pair as (select event_id, station, {round6(km("e.latitude", "e.longitude", "s.latitude", "s.longitude"))} as distance_km from catalog e, began s where e.magnitude >= 45e-1 and (s.since is null or s.since <= e.t_us))
select * from (select event_id, station, distance_km, row_number() over (partition by event_id order by distance_km, station) as rank from pair where distance_km <= 400) where rank <= 12""")
def k_nearest_installed(spark, d):
    e = catalog(spark, d).where("magnitude >= 4.5").select("event_id", "latitude", "longitude", F.unix_micros("time_utc").alias("t_us"))
    number = F.col("station").cast("int")
    since = F.when(number % 5 > 0, F.lit(1_704_067_200_000_000) + (number % 30).cast("long") * 86_400_000_000).alias("since")
    s = stations(spark, d).where("has_strong_motion").select("station", F.col("latitude").alias("slat"), F.col("longitude").alias("slon"), since)
    distance = S.np_round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.col("slat"), F.col("slon")), 6)
    return joins.k_nearest(e, s, "event_id", "station", distance, 12, 400.0, joins.installed(F.col("t_us"), F.col("since"))).select("event_id", "station", "distance_km", "rank")


@query(f"""with {B.LOG}, {B.CATALOG}, ok as (select event_id, string_agg(distinct station, ',' order by station) as stations from (select event_id, cast(n % 13 as varchar) as station from fetch_log where status = 'ok') group by all)
select event_id, stations, {round6("latitude")} as latitude, {round6("magnitude")} as magnitude from ok join catalog using (event_id)""")
def target_events(spark, d):
    log = fetch_log(spark, d).withColumn("station", (F.col("n") % 13).cast("string"))
    return joins.target_events(log, catalog(spark, d)).select("event_id", F.array_join("stations", ",").alias("stations"), r6("latitude"), r6("magnitude"))


@query(f"""with {B.CATALOG} select source, case when n > 0 then 'catalog_records_observed' else 'catalog_source_status_unverified' end as status from (values ('usgs'), ('isc'), ('emsc'), ('other')) as k(source) left join (select source, count(*) as n from catalog group by all) using (source)
union all select 'stations', case when count(vs30_ms) > 0 then 'vs30_values_observed' else 'no_vs30_values_observed' end from (select * from supplier), lateral (select 150e0 + abs(s_acctbal) / 10e0 as vs30_ms)""")
def source_statuses(spark, d):
    from faultline.operators import provenance

    kinds = {"usgs": "catalog", "isc": "catalog", "emsc": "catalog", "other": "catalog", "stations": "sites"}
    return provenance.source_statuses(provenance.lineage_counts(catalog(spark, d), stations(spark, d)), kinds)


@query()
def validation_report(spark, d):
    """Every check over one data set; each check's SQL is that of the checks_ queries."""
    g = windows.sessionize(catalog(spark, d).select("event_id", "t_sec"), "event_id", "t_sec").select("event_id", "window_group")
    f = event_station(spark, d).join(g, "event_id", "left")
    named = g.select(F.lit("event_split").alias("task"), splits.hash_split(F.col("event_id")).alias("split"), "event_id")
    return validation.validate(_dataset(spark, d), stations(spark, d), broken_features(spark, d), f, {"events": named}, features(spark, d).select(F.col("file").alias("path")), fetch_log(spark, d))
