"""Joins that Catalyst has no rewrite for: time bands, range aggregates, nearest neighbours; and id maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.scalar import haversine_km

#: Rows of the smaller side that are broadcast at once; a larger side is taken in blocks of this size.
BROADCAST_ROWS = 50_000


def band_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, before: float, after: float, condition: Column | None = None, how: str = "inner") -> DataFrame:
    """Pairs with right_time in [left_time - before, left_time + after], both ends included.

    A bare range predicate plans as a nested loop. Here each left row goes to the one or more buckets
    its band touches, right rows to their own, and the equality of buckets makes it a hash or merge
    join that shuffles both sides once. Columns of the two sides must differ in name.
    """
    width = float(before + after) or 1.0
    low, high = F.floor((F.col(left_time) - before) / width), F.floor((F.col(left_time) + after) / width)
    l = left.withColumn("__bucket", F.explode(F.sequence(low, high)))
    r = right.withColumn("__bucket_r", F.floor(F.col(right_time) / width))
    on = (F.col("__bucket") == F.col("__bucket_r")) & F.col(right_time).between(F.col(left_time) - before, F.col(left_time) + after)
    if condition is not None:
        on = on & condition
    if how != "inner":
        raise ValueError("a row stands in several buckets: join the result back for outer semantics")
    return l.join(r, on).drop("__bucket", "__bucket_r")


def self_band_join(events: DataFrame, order: str, time: str, most: float) -> DataFrame:
    """Pairs i < j (by ``order``, which follows time) with a time difference of at most ``most``; columns get suffixes _a and _b."""
    a = events.select(*(F.col(c).alias(f"{c}_a") for c in events.columns))
    b = events.select(*(F.col(c).alias(f"{c}_b") for c in events.columns))
    return band_join(a, b, f"{time}_a", f"{time}_b", 0.0, most, F.col(f"{order}_a") < F.col(f"{order}_b"))


def range_max(rows: DataFrame, catalog: DataFrame, key: str, time: str, other_key: str, other_time: str, value: str, before: float, after: float, exclude_self: bool, name: str) -> DataFrame:
    """``rows`` with ``name``: the largest value of catalogue rows within the band (NULL if none), not counting rows of the own id."""
    c = catalog.select(F.col(other_key).alias("__id"), F.col(other_time).alias("__time"), F.col(value).alias("__value"))
    pairs = band_join(rows.select(key, time).distinct(), c, time, "__time", before, after, F.col("__id") != F.col(key) if exclude_self else None)
    best = pairs.groupBy(key, time).agg(F.max("__value").alias(name))
    return rows.join(best, [key, time], "left")


def nearest(points: DataFrame, places: DataFrame, key: str, flags: dict[str, Column], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Per point, for every flag name: ``<name>`` and ``<name>_distance_km`` of the nearest place for which it holds.

    Distinct positions are solved once and joined back. ``places`` (key, latitude, longitude, columns
    of the flags) is counted: up to ``BROADCAST_ROWS`` rows it is one broadcast, beyond that it is
    taken in blocks of that size whose winners are then compared, which is exact at any size.
    Distances are compared to a micrometre, and equal ones by key: places just as far in two directions
    differ in the last bits of a double only.
    """
    where = points.select(F.col(lat).alias("__lat"), F.col(lon).alias("__lon")).distinct()
    n = places.count()
    blocks = [places] if n <= BROADCAST_ROWS else [places.where(F.pmod(F.xxhash64(key), F.lit(-(-n // BROADCAST_ROWS))) == i) for i in range(-(-n // BROADCAST_ROWS))]
    found = None
    for block in blocks:
        pairs = where.join(F.broadcast(block), F.lit(True), "left")
        d = F.rint(haversine_km(F.col("__lat"), F.col("__lon"), F.col("latitude"), F.col("longitude")) * 1e9)
        aggs = [F.min(F.when(flag, F.struct(d.alias("d"), F.col(key).alias("k")))).alias(name) for name, flag in flags.items()]
        best = pairs.groupBy("__lat", "__lon").agg(*aggs)
        found = best if found is None else found.unionByName(best)
    if len(blocks) > 1:
        found = found.groupBy("__lat", "__lon").agg(*(F.min(name).alias(name) for name in flags))
    out = []
    for name in flags:
        out += [F.col(f"{name}.k").alias(name), (F.col(f"{name}.d") / 1e9).alias(f"{name}_distance_km")]
    found = found.select("__lat", "__lon", *out)
    return points.join(found, points[lat].eqNullSafe(found["__lat"]) & points[lon].eqNullSafe(found["__lon"]), "left").drop("__lat", "__lon")


def k_nearest(points: DataFrame, places: DataFrame, key: str, place: str, distance: Column, k: int, most_km: float, condition: Column) -> DataFrame:
    """Up to ``k`` places for each point within ``most_km``, nearest first; names of the two sides must differ.

    More than ``BROADCAST_ROWS`` places are taken in blocks; the best ``k`` of each block are ranked again.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy("distance_km", place))
    n = -(-places.count() // BROADCAST_ROWS)
    blocks = [places] if n <= 1 else [places.where(F.pmod(F.xxhash64(place), F.lit(n)) == i) for i in range(n)]
    found = None
    for block in blocks:
        pairs = points.join(F.broadcast(block), condition).withColumn("distance_km", distance).where(F.col("distance_km") <= most_km)
        best = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
        found = best if found is None else found.unionByName(best)
    return found if n <= 1 else found.withColumn("rank", rank).where(F.col("rank") <= k)


def until_successes(attempts: DataFrame, key: str, order: list[str], ok: Column, target: int) -> DataFrame:
    """Attempts made, in order, until ``target`` of them succeeded."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum(ok.cast("int")).over(w) - ok.cast("int")
    return attempts.withColumn("__before", before).where(F.col("__before") < target).drop("__before")


def active_at(rows: DataFrame, channels: DataFrame | None, station: str, time: str) -> DataFrame:
    """Rows whose station had a channel active at their time (open ends are always active); no table: all rows."""
    if channels is None:
        return rows
    c = channels.select(F.col("station").alias("__s"), F.col("start_date").alias("__from"), F.col("end_date").alias("__to"))
    t = F.col(time)
    on = (F.col(station) == F.col("__s")) & (F.col("__from").isNull() | (F.col("__from") <= t)) & (F.col("__to").isNull() | (t <= F.col("__to")))
    return rows.join(c, on, "left_semi")


def activity_envelope(channels: DataFrame) -> DataFrame:
    """Earliest start and latest end by station and instrument type."""
    return channels.groupBy("station", "instrument_type").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def id_lookup(id_map: DataFrame, order: Column) -> DataFrame:
    """First representative of each source id."""
    return id_map.groupBy("source_event_id").agg(F.min_by("representative_event_id", order).alias("representative_event_id"))


def remap(rows: DataFrame, lookup: DataFrame, column: str = "event_id") -> DataFrame:
    """Ids replaced by their representative; unknown ids stay."""
    l = lookup.select(F.col("source_event_id").alias(column), F.col("representative_event_id").alias("__rep"))
    return rows.join(l, column, "left").withColumn(column, F.coalesce("__rep", column)).select(*rows.columns)


def collapse_duplicates(rows: DataFrame, original: str, order: str, event: str = "event_id", station: str = "station") -> DataFrame:
    """One row for each event and station: that whose original id is the representative, else the first."""
    w = Window.partitionBy(event, station).orderBy(~F.col(original).eqNullSafe(F.col(event)), order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def best_candidate(hits: DataFrame, target: str, event: str, target_magnitude: str, magnitude: str, order: str) -> DataFrame:
    """Of the search hits of each target, the one of the least magnitude difference (a missing magnitude differs by 0)."""
    diff = F.coalesce(F.abs(F.col(magnitude) - F.col(target_magnitude)), F.lit(0.0))
    return hits.groupBy(target).agg(F.min_by(event, F.struct(diff, F.col(order), F.col(event))).alias(event))


def earliest_picks(picks: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    return picks.groupBy(*keys).agg(F.min(time).alias(time), F.min_by(value, F.struct(time, value)).alias(value))


def installed(time: Column, start: Column) -> Column:
    """Stations whose start is unknown, or not after the event, as a condition of a join."""
    return start.isNull() | (start <= time)


def target_events(log: DataFrame, events: DataFrame, order: str = "time_utc") -> DataFrame:
    """Events that have successful requests: their stations as a sorted set, and the earliest row's place, time and magnitude."""
    ok = log.where("status = 'ok'").groupBy("event_id").agg(F.array_sort(F.collect_set("station")).alias("stations"))
    columns = [c for c in ("latitude", "longitude", "time_utc", "magnitude") if c in events.columns]
    row = F.min_by(F.struct(*columns), F.struct(order, *columns)).alias("e")
    return ok.join(events.groupBy("event_id").agg(row), "event_id").select("event_id", "stations", "e.*")
