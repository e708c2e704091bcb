"""Toxicity: a counterfactually regularised linear classifier.

Features of a text are the hashes of its words and of their first 4, 5 and 6 bytes, as present or
absent. The model is fitted on a bounded sample of labelled rows (``MOST_ROWS`` of each label, in the
order of a hash of their key): features of at least ``MIN_TEXTS`` toxic sample texts are counted, the
``FEATURES`` most telling ones kept, and a logistic regression fitted whose loss adds, for every
sample text that names an identity group, the squared change of its logit when the group's terms are
swapped for another group's. So a neutral mention of a group adds no score. The intercept is moved
from the sample's share of toxic rows to the share among all rows that may be learned from.

Scoring reads only the text. Nulls and empty texts get the score of no features. Without rows of both
labels the score is the (smoothed) share of toxic rows for every text. Labels that are null, or of a
null key, are not learned from; repeated rows have equal scores; only named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import slices, tidy, written
from faultline.llm.textvec import Words, mix64

_U64 = np.uint64
MOST_ROWS = 4000
MIN_TEXTS = 5
FEATURES = 4096
#: Least information, in nats over the sample, that a feature tells about the label (twice that is a G statistic).
MIN_GAIN = 6.0
PREFIXES = (4, 5, 6)
#: Identity terms, by kind of group; a term is swapped for the next one of its kind.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "indigenous"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees"), ("disabled", "deaf", "blind"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


def swapper(groups: tuple[tuple[str, ...], ...] = IDENTITIES):
    """A function that swaps every identity term of a text, or gives None if there is none."""
    to = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if not to:
        return lambda text: None
    terms = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(to, key=len, reverse=True))) + r")(?!\w)", re.IGNORECASE)

    def swap(text: str) -> str | None:
        out, n = terms.subn(lambda m: to.get(m[0].lower(), m[0]), text)
        return out if n else None

    return swap


def hashes(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of each word's features, one kind after the other."""
    yield w.doc, w.hash
    for k in PREFIXES:
        long = np.flatnonzero(w.end - w.start > k)
        yield w.doc[long], mix64(w.of(w.start[long], w.start[long] + k) + _U64(k * 0x51ED2701))


class Lookup:
    """Places of 64-bit hashes in a sorted array, through a bitmap of their low bits."""

    def __init__(self, known: np.ndarray):
        self.known, self.map = known, np.zeros(1 << 18, dtype=bool)
        self.map[(known & _U64((1 << 18) - 1)).astype(np.int64)] = True

    def features(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, place) of the features that are known, by row."""
        out = []
        for row, h in hashes(w):
            some = np.flatnonzero(self.map[(h & _U64((1 << 18) - 1)).astype(np.int64)])
            at = np.searchsorted(self.known, h[some])
            at[at == len(self.known)] = 0
            same = self.known[at] == h[some] if len(self.known) else np.zeros(0, bool)
            out.append(row[some[same]].astype(np.int64) * len(self.known) + at[same])
        key = np.unique(np.concatenate(out))
        return (key // max(1, len(self.known)), key % max(1, len(self.known)))


@dataclass
class Model:
    known: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: pa.Array, lookup: Lookup | None = None) -> np.ndarray:
        row, at = (lookup or Lookup(self.known)).features(Words(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + np.bincount(row, self.weight[at], len(texts)), -40, 40)))


def fit_rows(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int, l2: float = 2e-5, counterfactual: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept; ``rows``: features of each text; ``pairs``: those of a text and of its swapped form."""
    col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # of a pair only the features that differ count
    d_col = np.concatenate([np.concatenate(p) for p in pairs]) if pairs else np.zeros(0, np.int64)
    d_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    d_val = np.concatenate([np.concatenate([np.ones(len(a)), -np.ones(len(b))]) for a, b in pairs]) if pairs else np.zeros(0)
    w, b = np.zeros(n), float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for i in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], len(rows)), -40, 40)))
        g = np.bincount(col, ((p - y) / len(y))[row], n) + l2 * w
        if pairs:
            change = np.bincount(d_row, w[d_col] * d_val, len(pairs))
            g += counterfactual * 2 * np.bincount(d_col, change[d_row] * d_val, n) / len(pairs)
        g = np.append(g, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (1 - i / (steps + 1)) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def may_learn(key: Column) -> Column:
    """Rows of which labels may be learned: the checksum of the key as text, modulo 3, is not 1."""
    return F.crc32(key.cast("string").cast("binary")) % 3 != 1


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", groups: tuple[tuple[str, ...], ...] = IDENTITIES, counterfactual: float = 1.0, most_rows: int = MOST_ROWS) -> Model:
    spark = documents.sparkSession
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(label).cast("int").alias("y"))
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    prior = (share.get(1, 0) + 1) / (sum(share.values()) + 2)
    nothing = Model(np.zeros(0, _U64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if len(share) < 2:
        return nothing
    ids = [known.where(F.col("y") == y).distinct().orderBy(F.xxhash64("__k"), "__k").limit(most_rows) for y in (0, 1)]
    picked = spark.createDataFrame([tuple(r) for i in ids for r in i.collect()], known.schema)  # at most 2 * most_rows
    texts = documents.select(F.col(key).alias("__k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = written(texts.join(F.broadcast(picked), "__k").select("y", "text"), "labelled")

    def of_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, h = (np.concatenate(x) for x in zip(*hashes(Words(batch.column("text"))), strict=True))
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
            value, n = np.unique(h[new], return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": pa.array(value.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    told = sample.where("y = 1").select("text").mapInArrow(tidy(of_toxic), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TEXTS)
    candidates = np.sort(told.select("h").toArrow().column("h").to_numpy().view(_U64))  # bounded by the sample
    sent, swap_groups = spark.sparkContext.broadcast(candidates), groups

    def of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, swap = Lookup(sent.value), swapper(swap_groups)
        lists = lambda texts: np.split((got := lookup.features(Words(texts)))[1].astype(np.int32), np.searchsorted(got[0], np.arange(1, len(texts))))
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            other = [swap(t) for t in texts.to_pylist()]
            swapped = lists(pa.array([o or "" for o in other], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(lists(texts), pa.list_(pa.int32())), pa.array([s if o is not None else None for s, o in zip(swapped, other, strict=True)], pa.list_(pa.int32()))], names=["y", "f", "g"]
            )

    rows = sample.mapInArrow(tidy(of_all), "y int, f array<int>, g array<int>").toArrow()  # at most the sample
    y = rows.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return nothing
    feats = [np.array(x, np.int64) for x in rows.column("f").to_pylist()]
    swapped = rows.column("g").to_pylist()
    n = len(candidates)
    each = np.concatenate(feats)
    of = np.repeat(y, [len(f) for f in feats])
    pos, neg, a, b = np.bincount(each[of == 1], minlength=n), np.bincount(each[of == 0], minlength=n), y.sum(), len(y) - y.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        share_all = (pos + neg) / len(y)
        entropy = lambda k, t: np.nan_to_num(k * np.log(k / t)) + np.nan_to_num((t - k) * np.log((t - k) / t))
        gain = entropy(pos, a) + entropy(neg, b) - np.nan_to_num(len(y) * (share_all * np.log(share_all) + (1 - share_all) * np.log(1 - share_all)))
    keep = np.argsort(-gain, kind="stable")[:FEATURES]
    keep = np.sort(keep[gain[keep] >= MIN_GAIN])
    place = np.full(n, -1)
    place[keep] = np.arange(len(keep))
    take = lambda f: (p := place[np.asarray(f, np.int64)])[p >= 0]
    small = [take(f) for f in feats]
    pairs = [(np.setdiff1d(take(f), take(g)), np.setdiff1d(take(g), take(f))) for f, g in zip(feats, swapped, strict=True) if g is not None]
    w, bias = fit_rows(small, y, pairs, len(keep), counterfactual=counterfactual)
    in_sample = a / len(y)
    bias += float(np.log(prior / (1 - prior)) - np.log(in_sample / (1 - in_sample)))
    on = np.abs(w) > 1e-4
    return Model(candidates[keep][on], w[on], bias)


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``__score``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    columns = documents.columns
    rows = documents.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(sent.value.known)
        for batch in slices(batches, "__text"):
            scores = pa.array(sent.value.scores(batch.column("__text"), lookup))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), scores], names=[*columns, "__score"])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return rows.mapInArrow(tidy(apply), f"{schema}, __score double")
