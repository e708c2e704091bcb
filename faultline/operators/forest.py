"""A regression forest whose bootstrap draws every row, and whose trees are grown from sums of cells.

Trees split between the bins of each feature, so rows that share all their bins (a cell of the grid) take
one path in every tree, and a tree needs of a cell only how often its rows were drawn and the sum of their
labels. Rows that share cell and label are one row with a count: its draws are Poisson with that mean, which
is the sum of as many draws of mean 1. The draws run in blocks of about ``BLOCK`` such rows (a larger cell
has several blocks, by its labels), the trees in groups of ``GROUP`` in tasks of their own; only trees reach
the driver. Blocks and trees draw from the seed and their number, and rows are sorted, so the trees do not
depend on partitions or on the order of rows.

A grid of more than ``CELLS`` cells (four continuous features) has no use for this: Spark's own trees are
fitted then, on the same rows with the same parameters.
"""

from __future__ import annotations

from math import ceil, prod

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import stored

#: Cells of the largest grid.
CELLS = 1 << 17
#: Distinct rows, about, of which one task draws, and cells that it holds.
BLOCK, HELD = 50_000, 4096
#: Trees that one task grows.
GROUP = 10
#: Rows drawn at a time.
ROWS = 2048


def _valid(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.raise_error(F.lit(f"{name} is null or NaN")).cast("double")).otherwise(c)


def thresholds(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Ascending, by feature: between all neighbouring values if they are at most ``bins``, else quantiles of all rows."""
    probabilities = [i / bins for i in range(1, bins)]
    found = rows.agg(
        *(F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(features)), *(F.percentile_approx(c, probabilities, 10_000).alias(f"q{i}") for i, c in enumerate(features)),
        *(F.max(c).alias(f"m{i}") for i, c in enumerate(features)),
    ).first()
    if found["m0"] is None:
        raise ValueError("no rows to fit")
    out = []
    for i, c in enumerate(features):
        if found[f"n{i}"] <= 2 * bins:
            values = np.array(sorted(r[0] for r in rows.select(c).distinct().collect()))
            if len(values) <= bins:
                out.append((values[:-1] + values[1:]) / 2)
                continue
        quantiles = np.unique(found[f"q{i}"])
        out.append(quantiles[quantiles < found[f"m{i}"]])
    return out


def cell(features: list[str], cuts: list[np.ndarray]) -> Column:
    """Number of a row's cell: the bins of the first feature vary fastest; a bin holds its upper threshold."""

    def bin_of(x: Column, cut: np.ndarray, lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x <= F.lit(float(cut[mid])), bin_of(x, cut, lo, mid)).otherwise(bin_of(x, cut, mid + 1, hi))

    out, size = F.lit(0), 1
    for c, cut in zip(features, cuts, strict=True):
        out = out + bin_of(F.col(c), cut, 0, len(cut)) * F.lit(size)
        size *= len(cut) + 1
    return out


def drawn(rows: DataFrame, trees: int, seed: int, cells: int) -> DataFrame:
    """Bootstraps of ``rows`` (cell, y): by block and group of trees, its cells, and by cell and tree the rows drawn and the sum of their labels (binary)."""
    rows = stored(rows.groupBy("cell", "y").agg(F.count(F.lit(1)).alias("m")))
    blocks = max(ceil(rows.count() / BLOCK), ceil(cells / HELD))
    large = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).where("parts > 1")
    rows = rows.join(F.broadcast(large), "cell", "left")  # at most a row for each block
    part = F.pmod(F.xxhash64("y"), F.coalesce("parts", F.lit(1)))
    rows = rows.select("cell", "y", "m", F.pmod(F.xxhash64("cell", part), F.lit(blocks)).cast("int").alias("block"))

    def draw(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["cell", "y"])
        number, y, m = int(block["block"].iloc[0]), block["y"].to_numpy(), block["m"].to_numpy()
        own, place = np.unique(block["cell"].to_numpy(), return_inverse=True)
        rng = np.random.default_rng([seed, 1, number])
        w, s = np.zeros((len(own), trees)), np.zeros((len(own), trees))
        for i in range(0, len(y), ROWS):
            at = place[i : i + ROWS]
            first = np.flatnonzero(np.diff(at, prepend=-1))
            counts = rng.poisson(m[i : i + ROWS, None], (len(at), trees)).astype(float)
            w[at[first]] += np.add.reduceat(counts, first)
            counts *= y[i : i + ROWS, None]
            s[at[first]] += np.add.reduceat(counts, first)
        groups = range(0, trees, GROUP)
        raw = own.astype(np.int64).tobytes()
        return pd.DataFrame({"block": number, "group": list(groups), "cells": [raw] * len(groups), "w": [w[:, g : g + GROUP].tobytes() for g in groups], "s": [s[:, g : g + GROUP].tobytes() for g in groups]})

    return rows.groupBy("block").applyInPandas(draw, "block int, group int, cells binary, w binary, s binary")


def grow(w: np.ndarray, s: np.ndarray, codes: list[np.ndarray], bins: list[int], depth: int, least: int, take: int, rng: np.random.Generator) -> np.ndarray:
    """One tree by levels, a row a node: feature (-1: a leaf), last bin to the left, left child (the right one follows), prediction, gain."""
    some = w > 0
    w, s, codes = w[some], s[some], [c[some] for c in codes]
    at = np.zeros(len(w), np.int64)
    total = w.sum()
    tree = [np.array([[-1, 0, 0, s.sum() / total if total else 0.0, 0.0]])]
    start, n = 0, 1
    for _ in range(depth):
        here = np.flatnonzero(at >= start)
        if not len(here):
            break
        node, hw, hs = at[here] - start, w[here], s[here]
        all_w, all_s = np.bincount(node, hw, n), np.bincount(node, hs, n)
        best, by, last = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
        rank = rng.random((n, len(codes))).argsort(axis=1).argsort(axis=1)
        for f, size in enumerate(bins):
            if size < 2:
                continue
            key = node * size + codes[f][here]
            lw = np.bincount(key, hw, n * size).reshape(n, size).cumsum(axis=1)[:, :-1]
            ls = np.bincount(key, hs, n * size).reshape(n, size).cumsum(axis=1)[:, :-1]
            rw, rs = all_w[:, None] - lw, all_s[:, None] - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                left, right = ls / lw, rs / rw
                apart = np.where(np.abs(left - right) > 1e-12 * (np.abs(left) + np.abs(right)), left - right, 0.0)
                gain = np.where((lw >= least) & (rw >= least) & (rank[:, f] < take)[:, None], lw * rw / all_w[:, None] * apart * apart, 0.0)
            place = gain.argmax(axis=1)
            value = gain[np.arange(n), place]
            better = value > best
            best[better], by[better], last[better] = value[better], f, place[better]
        split = np.flatnonzero(by >= 0)
        if not len(split):
            break
        child = np.zeros(n, np.int64)
        child[split] = start + n + 2 * np.arange(len(split))
        tree[-1][:, 0], tree[-1][:, 1], tree[-1][:, 2], tree[-1][:, 4] = by, last, child, best
        moves = by[node] >= 0
        here, node = here[moves], node[moves]
        code = np.choose(by[node], [c[here] for c in codes]) if len(codes) < 32 else np.array(codes)[by[node], here]
        at[here] = child[node] + (code > last[node])
        start, n = start + n, 2 * len(split)
        node = at[here] - start
        mean = np.bincount(node, s[here], n) / np.bincount(node, w[here], n)
        tree.append(np.column_stack([np.full(n, -1.0), np.zeros(n), np.zeros(n), mean, np.zeros(n)]))
    return np.concatenate(tree)


def predict(tree: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """The tree's prediction for each row of bin numbers."""
    every, at = np.array(codes), np.zeros(len(codes[0]), np.int64)
    feature, last, left = (tree[:, i].astype(np.int64) for i in range(3))
    while len(on := np.flatnonzero(feature[at] >= 0)):
        node = at[on]
        at[on] = left[node] + (every[feature[node], on] > last[node])
    return tree[at, 3]


class CellForestModel(Model):
    """Trees over a grid; a row's prediction is that of its cell."""

    def __init__(self, features: list[str], cuts: list[np.ndarray], trees: list[np.ndarray], column: str):
        super().__init__()
        self.features, self.cuts, self.trees, self.column = features, cuts, trees, column

    @property
    def getNumTrees(self) -> int:  # as Spark's model has it
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """By feature: its share of a tree's gains, on average over the trees that split."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            inner = t[:, 0] >= 0
            if inner.any():
                total += np.bincount(t[inner, 0].astype(np.int64), t[inner, 4], len(total)) / t[inner, 4].sum()
        return DenseVector(total / total.sum() if total.sum() else total)

    def grid(self) -> np.ndarray:
        codes = _codes([len(c) + 1 for c in self.cuts])
        return sum(predict(t, codes) for t in self.trees) / len(self.trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = self.grid()
        grid = dataset.sparkSession.createDataFrame(pd.DataFrame({"__cell": np.arange(len(values), dtype=np.int32), self.column: values}))
        checked = dataset.withColumns({f"__v{i}": _valid(c) for i, c in enumerate(self.features)})
        names = [f"__v{i}" for i in range(len(self.features))]
        return checked.withColumn("__cell", cell(names, self.cuts)).join(F.broadcast(grid), "__cell").drop("__cell", *names)


def _codes(bins: list[int]) -> list[np.ndarray]:
    """Bin numbers of all cells of a grid, by feature."""
    at = np.arange(prod(bins))
    return [at // prod(bins[:i]) % n for i, n in enumerate(bins)]


class CellForest(RandomForestRegressor):
    """Spark's forest by its parameters (Poisson bootstrap, a third of the features a node), fitted on cells of ``features``."""

    def __init__(self, features: list[str], **params):
        super().__init__(**params)
        self.features = features

    def _fit(self, dataset: DataFrame):
        rows = stored(dataset.select(*(_valid(c).alias(c) for c in self.features), _valid(self.getLabelCol()).alias("__y")))
        cuts = thresholds(rows, self.features, self.getMaxBins())
        bins = [len(c) + 1 for c in cuts]
        if prod(bins) > CELLS:
            return super()._fit(dataset)
        trees, seed, depth, least, take = self.getNumTrees(), self.getSeed(), self.getMaxDepth(), self.getMinInstancesPerNode(), ceil(len(bins) / 3)
        sums = drawn(rows.select(cell(self.features, cuts).alias("cell"), F.col("__y").alias("y")), trees, seed, prod(bins))

        def plant(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("block")
            first = int(group["group"].iloc[0])
            held = min(GROUP, trees - first)
            w, s = np.zeros((prod(bins), held)), np.zeros((prod(bins), held))
            for cells, some_w, some_s in zip(group["cells"], group["w"], group["s"], strict=True):
                own = np.frombuffer(cells, np.int64)
                w[own] += np.frombuffer(some_w).reshape(-1, held)
                s[own] += np.frombuffer(some_s).reshape(-1, held)
            codes = _codes(bins)
            grown = [grow(w[:, t].copy(), s[:, t].copy(), codes, bins, depth, least, take, np.random.default_rng([seed, 2, first + t])) for t in range(held)]
            return pd.DataFrame({"tree": range(first, first + held), "nodes": [t.tobytes() for t in grown]})

        planted = sums.groupBy("group").applyInPandas(plant, "tree int, nodes binary").orderBy("tree").collect()
        return CellForestModel(self.features, cuts, [np.frombuffer(r["nodes"]).reshape(-1, 5) for r in planted], self.getPredictionCol())
