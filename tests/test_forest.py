import numpy as np
from pyspark.sql import functions as F


def _forest_rows(spark, n=4000):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 5, n), rng.random(n), rng.random(n)]).astype(float)
    y = x[:, 0] + np.where(x[:, 1] > 0.5, 3.0, 0.0) + rng.normal(0, 0.1, n)
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))], "i long, a double, b double, c double, y double")


def test_forest_does_not_depend_on_partitions_and_predicts_as_well_as_sparks(spark, monkeypatch):
    from faultline.operators import forest, stats

    rows = _forest_rows(spark)
    got = []
    for d in (rows.repartition(1), rows.orderBy("y").repartition(7)):
        out, share = stats.random_forest(d.where("i % 4 > 0"), d.where("i % 4 = 0"), ["a", "b", "c"], "y", trees=12)
        got.append(({r.i: r.prediction for r in out.collect()}, share, stats.regression_scores(out, F.col("y"), F.col("prediction")).first().rmse))
    assert got[0][:2] == got[1][:2] and len(got[0][0]) == 1000 and got[0][1]["b"] > got[0][1]["c"]
    monkeypatch.setattr(forest, "CELLS", 10)  # Spark's own trees
    out, _ = stats.random_forest(rows.where("i % 4 > 0"), rows.where("i % 4 = 0"), ["a", "b", "c"], "y", trees=12)
    assert out.count() == 1000
    assert abs(stats.regression_scores(out, F.col("y"), F.col("prediction")).first().rmse / got[0][2] - 1) < 0.35


def test_forest_draws_every_row_and_splits_best(spark, monkeypatch):
    from faultline.operators import forest

    rows = spark.createDataFrame([(i % 3, float(i % 40)) for i in range(6000)], "cell int, y double")
    for block in (forest.BLOCK, 7):  # large cells in several blocks
        monkeypatch.setattr(forest, "BLOCK", block)
        w, s = np.zeros((3, 20)), np.zeros((3, 20))
        for r in forest.drawn(rows, 20, 1, 3).collect():
            own = np.frombuffer(r.cells, np.int64)
            t = slice(r.group, r.group + forest.GROUP)
            w[own, t] += np.frombuffer(r.w).reshape(len(own), -1)
            s[own, t] += np.frombuffer(r.s).reshape(len(own), -1)
        assert abs(w.mean() / 2000 - 1) < 0.02 and 20 < w.std() < 80  # Poisson: 45
        assert abs((s / w).mean() - 19.5) < 0.1
    rng = np.random.default_rng(5)
    codes = [rng.integers(0, 6, 300), rng.integers(0, 4, 300)]
    w = rng.integers(0, 4, 300).astype(float)
    s = w * rng.random(300)
    tree = forest.grow(w, s, codes, [6, 4], 1, 5, 2, np.random.default_rng(0))
    gains = {}
    for f, c in enumerate(codes):
        for last in range(c.max()):
            a = c <= last
            if w[a].sum() >= 5 and w[~a].sum() >= 5:
                gains[f, last] = s[a].sum() ** 2 / w[a].sum() + s[~a].sum() ** 2 / w[~a].sum() - s.sum() ** 2 / w.sum()
    best = max(gains, key=gains.get)
    assert tuple(tree[0, :2]) == best and abs(tree[0, 4] - gains[best]) < 1e-9
    left = codes[best[0]] <= best[1]
    assert np.allclose(forest.predict(tree, codes), np.where(left, s[left].sum() / w[left].sum(), s[~left].sum() / w[~left].sum()))
    assert len(forest.grow(w, 2.5 * w, codes, [6, 4], 8, 5, 2, np.random.default_rng(0))) == 1  # equal labels
