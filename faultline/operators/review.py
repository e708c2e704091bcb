"""Review of matches: pairs in twice the limits, strata, a weighted sample, and scores of reviewed labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.scalar import haversine_km
from faultline.operators.dedup import MAGNITUDE, MOST_KM, SECONDS, score, threshold_km, with_rank
from faultline.operators.joins import BROADCAST_ROWS, self_band_join
from faultline.session import stored

# --- fixed values: bounds and names of the strata ---
TIME_NAMES = ((1, "t00_01"), (5, "t01_05"), (15, "t05_15"), (30, "t15_30"), (60, "t30_60"))
DISTANCE_NAMES = ((0.5, "d00_050"), (1.0, "d050_100"), (1.25, "d100_125"), (2.0, "d125_200"))
MAGNITUDE_NAMES = ((0.25, "m00_025"), (0.75, "m025_075"), (1.5, "m075_150"), (3.0, "m150_300"))


def bucket(value: Column, names: tuple[tuple[float, str], ...]) -> Column:
    """Name of the first bound that is not exceeded; beyond all, the last name."""
    out = F.lit(names[-1][1])
    for bound, name in reversed(names):
        out = F.when(value <= bound, F.lit(name)).otherwise(out)
    return out


def with_strata(pairs: DataFrame) -> DataFrame:
    """Pairs (columns with _a and _b) within twice the limits, with differences, predicted_label, candidate_score and stratum."""
    pairs = pairs.withColumns({"time_diff_sec": F.col("t_sec_b") - F.col("t_sec_a"), "magnitude_diff": F.abs(F.col("magnitude_a") - F.col("magnitude_b"))}).where(F.col("magnitude_diff") <= 2 * MAGNITUDE)
    limit = threshold_km(F.greatest("magnitude_a", "magnitude_b"))
    pairs = pairs.withColumn("distance_threshold_km", limit).withColumn("distance_km", haversine_km(F.col("latitude_a"), F.col("longitude_a"), F.col("latitude_b"), F.col("longitude_b")))
    pairs = pairs.withColumn("distance_ratio", F.col("distance_km") / F.col("distance_threshold_km")).where((F.col("distance_km") <= 2 * MOST_KM) & (F.col("distance_ratio") <= 2))
    match = (F.col("source_a") != F.col("source_b")) & (F.col("time_diff_sec") <= SECONDS) & (F.col("magnitude_diff") <= MAGNITUDE) & (F.col("distance_km") <= F.col("distance_threshold_km"))
    same = F.when(F.col("source_a") == F.col("source_b"), "same_source").otherwise("cross_source")
    pairs = pairs.withColumn("predicted_label", F.when(match, "match").otherwise("non_match"))
    pairs = pairs.withColumn("candidate_score", F.when(match, score(F.col("time_diff_sec"), F.col("distance_km"), F.col("magnitude_diff"), F.col("distance_threshold_km"))))
    return pairs.withColumn("stratum", F.concat_ws("|", same, bucket(F.col("time_diff_sec"), TIME_NAMES), bucket(F.col("distance_ratio"), DISTANCE_NAMES), bucket(F.col("magnitude_diff"), MAGNITUDE_NAMES)))


def review_pairs(events: DataFrame) -> DataFrame:
    return with_strata(self_band_join(with_rank(events), "rank", "t_sec", 2 * SECONDS))


def review_classes(events: DataFrame) -> DataFrame:
    """The pairs of :func:`review_pairs` by stratum, as pairs of classes of reports that differ in their id only: lists ``ids_a``, ``ids_b``, and ``n``.

    Where ``same`` holds (one time and agency) the ids alone decide which report of a pair is a.
    """
    alike = ["source", "t_sec", "latitude", "longitude", "magnitude"]
    classes = events.select("source_event_id", *alike).dropna(subset=alike[1:]).groupBy(*alike).agg(F.collect_list("source_event_id").alias("ids"))
    classes = stored(classes.withColumn("source_event_id", F.array_min("ids")))
    between = self_band_join(with_rank(classes), "rank", "t_sec", 2 * SECONDS)
    n = F.size("ids_a").cast("long") * F.size("ids_b")
    same = (F.col("t_sec_a") == F.col("t_sec_b")) & F.col("source_a").eqNullSafe(F.col("source_b"))
    between = with_strata(between).select("stratum", "ids_a", "ids_b", same.alias("same"), F.lit(False).alias("own"), n.alias("n"))
    own = classes.where(F.size("ids") > 1).select(*(F.col(c).alias(f"{c}_{s}") for s in "ab" for c in (*alike, "ids")))
    m = F.size("ids_a").cast("long")
    return between.unionByName(with_strata(own).select("stratum", "ids_a", "ids_b", F.lit(True).alias("same"), F.lit(True).alias("own"), F.call_function("div", m * (m - 1), F.lit(2)).alias("n")))


def class_members(classes: DataFrame) -> DataFrame:
    """The pairs of reports of each pair of classes, as columns a and b."""
    pairs = classes.withColumn("a", F.explode("ids_a")).drop("ids_a").withColumn("b", F.explode("ids_b")).drop("ids_b")
    turned = F.col("same") & (F.col("a") > F.col("b"))
    pairs = pairs.where(~F.col("own") | (F.col("a") < F.col("b")))
    return pairs.withColumns({"a": F.when(turned, F.col("b")).otherwise(F.col("a")), "b": F.when(turned, F.col("a")).otherwise(F.col("b"))}).drop("same", "own", "n")


def stratified_sample(rows: DataFrame, stratum: str, ids: list[str], size: int = 20, seed: int = 20261025, weight: str | None = None, members: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Up to ``size`` rows a stratum, in the order of a seeded hash of their ids; with population, sample size and weight.

    A hash order needs no order of rows, so the sample does not depend on partitions. The size is the operator's feature.
    Rows are counted first; only those whose hash is in the share that has ``size`` rows many times over are
    ranked. A stratum that has too few there (copies of an id share a hash) is ranked whole. With ``weight``,
    a row stands for so many, which ``members`` makes of it.
    """
    if size < 1:
        raise ValueError("a sample has at least one row a stratum")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *ids).cast("binary"))
    counts = stored(rows.where(F.col(stratum).isNotNull()).groupBy(stratum).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("stratum_population")))
    few = counts.count() <= BROADCAST_ROWS
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("__order", *ids))

    def picked(strata: DataFrame, most: Column) -> DataFrame:
        strata = strata.withColumn("__most", most)
        found = rows.join(F.broadcast(strata) if few else strata, stratum)
        found = (members(found) if members else found).withColumn("__order", order).where(F.col("__order") < F.col("__most"))
        return stored(found.withColumn("__n", rank).where(F.col("__n") <= size).drop("__n", "__order", "__most"))

    share = (3 * size + 100) / F.col("stratum_population")
    out = picked(counts, F.when(share < 1, F.lpad(F.lower(F.hex((share * 16**15).cast("long"))), 15, "0")).otherwise(F.lit("g")))
    n = F.least(F.col("stratum_population"), F.lit(size)).cast("long")
    lacking = stored(counts.join(out.groupBy(stratum).agg(F.count(F.lit(1)).alias("__n")), stratum, "left").where(F.coalesce("__n", F.lit(0)) < n).drop("__n"))
    if not lacking.isEmpty():
        out = out.join(lacking.select(stratum), stratum, "left_anti").unionByName(picked(lacking, F.lit("g")))
    return out.withColumn("stratum_sample_size", n).withColumn("review_weight", F.col("stratum_population") / n)


def sampled_pairs(events: DataFrame, size: int = 20, seed: int = 20261025) -> DataFrame:
    """:func:`stratified_sample` of the :func:`review_pairs`, as stratum, ids a and b, population, sample size and weight."""
    return stratified_sample(review_classes(events), "stratum", ["a", "b"], size, seed, "n", class_members)


def score_reviews(rows: DataFrame, predicted: str = "predicted_label", label: str = "reviewer_label", weight: str = "review_weight") -> DataFrame:
    """Weighted TP, FP, FN, precision, recall, F1 (0 where undefined); a label or weight that is not valid is an error."""
    clean = lambda c: F.trim(F.lower(F.col(c)))
    ok = clean(predicted).isin("match", "non_match") & clean(label).isin("match", "non_match") & (F.col(weight) > 0)
    w = F.when(F.coalesce(ok, F.lit(False)), F.col(weight)).otherwise(F.raise_error(F.lit("labels must be match or non_match, weights above 0")).cast("double"))
    rows = rows.select(clean(predicted).alias("p"), clean(label).alias("y"), w.cast("double").alias("w"))
    total = lambda p, y: F.coalesce(F.sum(F.when((F.col("p") == p) & (F.col("y") == y), F.col("w"))), F.lit(0.0))
    out = rows.agg(total("match", "match").alias("tp"), total("match", "non_match").alias("fp"), total("non_match", "match").alias("fn"), F.sum("w").alias("total_weight"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
