import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import provenance, quality, review, splits, stats
from faultline.sources import tables


def named(df):
    return {r.check: (r.passed, r.detail) for r in df.collect()}


def test_scores(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["match", "non_match"]), rng.choice(["match", "non_match"]), rng.randint(1, 9)) for _ in range(50)]
    df = spark.createDataFrame(rows, "predicted_label string, reviewer_label string, review_weight int")
    r = review.score_reviews(df).first()
    total = collections.Counter()
    for p, true, w in rows:
        total[p, true] += w
    tp, fp, fn = total["match", "match"], total["match", "non_match"], total["non_match", "match"]
    assert (r.tp, r.fp, r.fn) == (tp, fp, fn) and r.precision == pytest.approx(tp / (tp + fp)) and r.recall == pytest.approx(tp / (tp + fn)) and r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    with pytest.raises(Exception, match="labels must be"):
        review.score_reviews(df.withColumn("reviewer_label", F.lit(" "))).collect()


def test_splits(spark):
    for key in ("one", "quake 17", "ü"):
        first = int(hashlib.md5(key.encode()).hexdigest()[:8], 16)
        assert spark.range(1).select(splits.hash_fraction(F.lit(key))).first()[0] == pytest.approx(first / 0xFFFFFFFF, abs=1e-9)
    counts = {"AA1": 70, "AA2": 155, "BB7": 9, "C": 31, "D04": 2, "ZZ": 88, "Q": 50}
    rows = [(s,) for s, n in counts.items() for _ in range(n)]
    a = {r.station: r.split for r in splits.station_split(spark.createDataFrame(rows, "station string")).collect()}
    b = {r.station: r.split for r in splits.station_split(spark.createDataFrame(rows[::-1], "station string")).collect()}
    assert a == b and set(a) == set(counts)
    share = spark.range(20000).select(splits.hash_split(F.col("id")).alias("s")).groupBy("s").count().collect()
    assert {r.s: round(r["count"] / 20000, 1) for r in share}["train"] == 0.7


def test_leakage_and_holdouts(spark):
    facts = spark.createDataFrame([("a", "g1"), ("b", "g1"), ("c", "g2")], "event_id string, window_group string")
    rows = lambda *x: spark.createDataFrame([("t", s, e) for s, e in x], "task string, split string, event_id string")
    assert named(quality.leakage(facts, rows(("train", "a"), ("train", "b"), ("test", "c"))))["leakage_t"] == (True, 0)
    assert named(quality.leakage(facts, rows(("train", "a"), ("test", "b"), ("test", "c"))))["leakage_t"] == (False, 1)
    assert quality.leakage(facts.drop("window_group"), facts) is None
    s = spark.createDataFrame([("train", "A"), ("train", None), ("test", "A")], "split string, station string")
    got = named(quality.station_holdout(s))
    assert not got["station_disjoint"][0] and not got["station_present"][0] and not got["splits_not_empty"][0]
    t = spark.createDataFrame([("train", "2021-12-31T23:59:59Z"), ("test", "2022-01-01T00:00:00Z")], "split string, time_utc string")
    assert all(p for p, _ in named(quality.time_holdout(t, "2022-01-01")).values())
    t = spark.createDataFrame([("train", "2022-01-01T00:00:00Z"), ("test", "no time")], "split string, time_utc string")
    assert not any(p for p, _ in named(quality.time_holdout(t, "2022-01-01")).values())


def test_features_rules(spark):
    h = spark.createDataFrame([(0.31, 0.31, 0.17, 0.05, 0.2296, 0.26), (0.14, 0.08, 0.11, 0.14, 0.0938, 0.1), (0.033, None, None, 0.033, None, None)], "pga_g double, pga_h1_g double, pga_h2_g double, pga_v_g double, pga_geomean_g double, pga_rotd50_g double")
    assert all(p for p, _ in named(quality.horizontal(h)).values())
    assert not named(quality.horizontal(h.withColumn("pga_rotd50_g", F.lit(0.5))))["rotd50_bounded"][0]
    assert quality.horizontal(h.drop("pga_h1_g")) is None
    d = spark.createDataFrame([(0.8, 1), (0.45, 2), (0.3, 4), (0.1, 1)], "dedup_confidence double, cluster_size int")
    assert named(quality.dedup_quality(d))["low_confidence_share"] == (False, 2)


def test_bootstrap(spark):
    rows = spark.createDataFrame([(i // 2, float(i), (-1.0) ** i + 0.1 * i) for i in range(40)], "g long, y double, r double")
    a = stats.cluster_bootstrap(rows, "g", "y", "r", reps=200)
    assert a == stats.cluster_bootstrap(rows.repartition(3), "g", "y", "r", reps=200) and a["rmse"][0] < a["rmse"][1]
    assert stats.cluster_bootstrap(rows.where("g = 0"), "g", "y", "r") is None
    assert stats.cluster_bootstrap(rows.withColumn("g", F.lit(None).cast("long")), "g", "y", "r") is None
    with pytest.raises(ValueError):
        stats.cluster_bootstrap(rows, "g", "y", "r", reps=0)


def test_bootstrap_in_blocks(spark, monkeypatch):
    """No group reaches the driver; blocks draw as a resample of all groups does."""
    import numpy as np

    rng = np.random.default_rng(4)
    own = [(f"g{i:03d}", float(rng.normal(3, 2)), float(rng.normal(0.2, 1 + i % 3))) for i in range(400)]
    rows = spark.createDataFrame([*own, ("unused", 1.0, float("nan")), ("unused", None, 1.0)], "g string, y double, r double")
    frames, to = [], type(rows).toPandas
    monkeypatch.setattr(type(rows), "toPandas", lambda self: frames.append(to(self)) or frames[-1])
    one = stats.cluster_bootstrap(rows, "g", "y", "r", reps=600)
    draws = np.random.default_rng(20261025)
    r = np.array([x[2] for x in own])
    means = [np.bincount(draws.integers(0, 400, size=400), minlength=400) @ r / 400 for _ in range(600)]
    assert one["bias"] == pytest.approx(tuple(np.quantile(means, [0.025, 0.975])))
    monkeypatch.setattr(stats, "GROUPS", 60)
    some = stats.cluster_bootstrap(rows, "g", "y", "r", reps=600)
    again = stats.cluster_bootstrap(rows.repartition(5, "y"), "g", "y", "r", reps=600)
    assert some != one and all(some[k] == pytest.approx(again[k]) for k in one)
    assert all(abs(a - b) < 0.15 * (one[k][1] - one[k][0]) for k in one for a, b in zip(one[k], some[k], strict=True))
    assert max(map(len, frames)) == 600


def test_picks(spark):
    r = stats.pick_errors(spark.createDataFrame([(0.25, 0.7), (0.5, 0.8), (1.5, 0.2), (4.0, 0.4)], "abs_error_sec double, confidence double")).first()
    assert (r["mean"], r["median"], r["share_over_1s"], r["mean_high_confidence"], r["mean_low_confidence"]) == (1.5625, 1.0, 0.5, 0.375, 2.75)


def test_manifest_diff(spark):
    old = spark.createDataFrame([("same", "1"), ("removed", "2"), ("kept", "3")], "path string, sha256 string")
    new = spark.createDataFrame([("same", "9"), ("added", "2"), ("kept", "3")], "path string, sha256 string")
    assert {(r.path, r.change) for r in provenance.diff_artifacts(old, new).collect()} == {("same", "changed"), ("removed", "removed"), ("added", "added")}
    with pytest.raises(ValueError):
        provenance.diff_artifacts(old.unionByName(old), new)


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "catalog")
    ok = lambda n: lambda: spark.range(n)

    def bad():
        raise OSError("down")

    assert tables.publish({2001: ok(2), 2000: ok(3)}, path, spark) == 5
    with pytest.raises(RuntimeError, match="2001"):
        tables.publish({2000: ok(1), 2001: bad}, path, spark)
    with pytest.raises(RuntimeError, match="no rows"):
        tables.publish({2000: ok(0)}, path, spark)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["catalog"]


def test_loader_arguments():
    assert tables.benchmark_path("ground_motion", "test", "time").endswith("holdout_by_time/split=test")
    for bad in (("ground_motion", "val", "time"), ("phase_picking", "test", "time"), ("../x", "test", None), ("early_warning", "dev", None)):
        with pytest.raises(ValueError):
            tables.benchmark_path(*bad)


def test_aligned_schema(spark):
    a = spark.createDataFrame([(1, None, None)], "n int, s double, t double")
    b = spark.createDataFrame([(2, "x", None)], "n int, s string, t double")
    assert [dict(d.dtypes) for d in tables.aligned({"a": a, "b": b}).values()] == [{"n": "int", "s": "string", "t": "string"}] * 2
