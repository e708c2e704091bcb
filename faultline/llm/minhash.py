"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

Weights. Shingles are runs of five words (a shorter text is one shingle). A shingle's weight in a
text is (1 + ln tf) * idf with idf = 1 + IDF_SCALE * ln((1 + n) / (1 + df)) / ln(1 + n): shingles of
many texts weigh less, but never so little that one changed word outweighs a copied page. df comes
from counts over all texts in ``BUCKETS`` hash buckets, less the mean of all buckets (the noise of
rare shingles); so what is sent to tasks has a fixed size at any scale.

Sampling. For sample k each shingle has r and c from Gamma(2, 1) and beta from [0, 1), taken from
tables by bits of its hash; t = floor(ln w / r + beta) and the shingle of the least
ln c - r * (t - beta + 1) is the sample. Two texts agree in a sample with the probability of their
weighted Jaccard similarity. ``BANDS`` bands of ``ROWS`` samples make bucket keys.

Candidates. Texts with equal words are one node. A bucket of at most ``SMALL`` members gives all its
pairs. In a larger one every member is first paired with up to three centres (least and least-hashed id,
and the member of most company, which the original of many edited copies tends to be), so rows grow in
proportion to members. Pairs are verified by the exact weighted similarity of whole texts, and components
are joined. Then every member that is not in the largest component of its bucket is compared with all
members of all its large buckets: such members are dealt in blocks of about ``DEAL``, the bucket's members
in runs of ``RUN``, and one task multiplies the weights of a block and a run, so no pair is ever a row and
no link inside a bucket is lost. Components come from star contraction over tables in the shared folder.

Nulls are empty texts. Texts without words are near copies of nothing; equal ones are one class.
Repeated rows are copies; very long texts are read whole, alone in their slice; keys are whole numbers
(a text that is no number fails, as a cast does); a null key never names a class unless all its members have none; an empty
table gives an empty result; only the key and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import cut, slices, tidy, written
from faultline.llm.textvec import Words, mix64

_U64 = np.uint64
SHINGLE = 5
BANDS, ROWS = 16, 4
IDF_SCALE = 0.25
BUCKETS = 1 << 18
SMALL = 12
#: Tasks that rows of one key are dealt over.
SALT = 16
_BITS = 13
#: Rows of a centre that one verification task gets.
SPREAD = 400
#: Members outside their bucket's largest component that are one block, and members that meet a block in one task.
DEAL, RUN = 256, 4096
#: Features of a block and a run that are multiplied at once.
WIDE = 1024


def _gamma(seed: int) -> np.ndarray:
    u = (mix64(np.arange(2 << _BITS, dtype=_U64) + _U64(seed << 32)) >> _U64(11)).astype(np.float64) / (1 << 53) + 2.0**-54
    return -np.log(u[: 1 << _BITS]) - np.log(u[1 << _BITS :])


def _tables() -> tuple[np.ndarray, ...]:
    r = np.maximum(_gamma(1), 1e-3)
    beta = ((np.arange(1 << _BITS) + 0.5) / (1 << _BITS)).astype(np.float32)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(_gamma(2)).astype(np.float32), beta


def shingles(texts: pa.Array, words: Words | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 44-bit hash and count of each distinct shingle, by row."""
    w = words or Words(texts)
    row, h = w.grams(SHINGLE)
    if len(texts) > 1 << 20:
        raise ValueError("slice the texts first")
    key = np.sort(row.astype(_U64) << _U64(44) | h >> _U64(20))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> _U64(44)).astype(np.int64), key & _U64((1 << 44) - 1), tf


def bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle & _U64(BUCKETS - 1)).astype(np.int64)


def idf_table(counts: np.ndarray, n: int) -> np.ndarray:
    """By bucket; ``counts``: texts that have a shingle in it."""
    df = np.clip(counts - counts.mean(), 1, n)
    return (1 + IDF_SCALE * np.log((1 + n) / (1 + df)) / np.log(1 + max(n, 2))).astype(np.float32)


def weights(shingle: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(tf)).astype(np.float32) * idf[bucket(shingle)]


def bands(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, tables: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and the keys of each in all bands."""
    r, inverse, ln_c, beta = tables
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    out = np.empty((len(first), BANDS), dtype=_U64)
    if not len(first):
        return row[first], out.view(np.int64)
    ends, mask = np.append(first, len(row)), _U64((1 << _BITS) - 1)
    sample = np.empty((len(first), BANDS * ROWS), dtype=np.float32)
    step, lo = 1 << 15, 0
    while lo < len(first):  # blocks that stay in the cache
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + step)) - 1)
        a, b = ends[lo], ends[hi]
        base, lnw, starts = shingle[a:b], np.log(weight[a:b]), first[lo:hi] - a
        for k in range(BANDS * ROWS):
            x = (base + _U64(k + 1)) * _U64((0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019) & (1 << 64) - 1 | 1)
            x ^= x >> _U64(29)
            x *= _U64(0xBF58476D1CE4E5B9)
            i, j, m = ((x >> _U64(s) & mask).astype(np.int32) for s in (51, 38, 25))
            bt = beta[j]
            t = np.floor(lnw * inverse[i] + bt)
            sample[lo:hi, k] = np.minimum.reduceat(ln_c[m] - r[i] * (t - bt + 1), starts)
        lo = hi
    bits = sample.view(np.uint32).astype(_U64).reshape(len(first), BANDS, ROWS)
    for j in range(ROWS):
        out = mix64((out if j else np.broadcast_to(np.arange(BANDS, dtype=_U64), out.shape)) * _U64(0x9FB21C651E98DF25) + bits[:, :, j])
    return row[first], out.view(np.int64)


def similarity(a: pa.Array, b: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each row (0 if either has no words)."""
    parts = []
    for x in (a, b):
        row, s, tf = shingles(x)
        parts.append((row.astype(_U64) << _U64(44) | s, weights(s, tf, idf).astype(np.float64), row))
    (ka, wa, ra), (kb, wb, rb) = parts
    n = len(a)
    total = np.bincount(ra, wa, n) + np.bincount(rb, wb, n)
    at = np.searchsorted(kb, ka)
    both = np.flatnonzero(at < len(kb))
    both = both[kb[at[both]] == ka[both]]
    least = np.bincount(ra[both], np.minimum(wa[both], wb[at[both]]), n)
    return np.divide(least, total - least, out=np.zeros(n), where=total - least > 0)


def content(w: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's words, or of its bytes if it has none."""
    nth = np.arange(len(w.hash)) - w.first[:-1][w.doc] if len(w.hash) else np.zeros(0, np.int64)
    out = []
    for c in (0xA24BAED4963EE407, 0x9FB21C651E98DF25):
        h = mix64(w.hash * _U64(c) + mix64(nth.astype(_U64) + _U64(c)))
        total = np.concatenate([np.zeros(1, _U64), np.cumsum(h, dtype=_U64)])
        out.append(mix64(total[w.first[1:]] - total[w.first[:-1]] + np.diff(w.first).astype(_U64)))
    bare = np.flatnonzero(np.diff(w.first) == 0)
    for i in bare.tolist():
        raw = w.data[w.off[i] : w.off[i + 1]].tobytes()
        for j, o in enumerate(out):
            o[i] = hash_bytes(raw, j)
    return out[0].view(np.int64), out[1].view(np.int64)


def hash_bytes(raw: bytes, salt: int) -> np.uint64:
    import hashlib

    return np.frombuffer(hashlib.blake2b(raw, digest_size=8, salt=bytes([salt + 1])).digest(), _U64)[0]


def _counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that have a shingle in each bucket, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches, "text"):
            row, s, _ = shingles(batch.column("text"))
            seen += np.bincount(bucket(s), minlength=BUCKETS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(seen[at])})

    total = rows.select("text").mapInArrow(tidy(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = total.toArrow()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS)
    counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return counts, rows.count()


def _signatures(rows: DataFrame, idf: object) -> DataFrame:
    """Per row: __id, key, two content hashes, and keys of its bands (none without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = idf.value, _tables()
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            w = Words(texts)
            row, s, tf = shingles(texts, w)
            at, keys = bands(row, s, weights(s, tf, table), tables)
            size = np.zeros(len(texts), np.int64)
            size[at] = BANDS
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(keys.ravel()))
            h1, h2 = content(w, texts)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("key"), pa.array(h1), pa.array(h2), lists], names=["__id", "key", "h1", "h2", "bands"])

    return rows.select("__id", "key", "text").mapInArrow(tidy(sign), "__id long, key long, h1 long, h2 long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, idf: object, least: float) -> DataFrame:
    """Pairs (a, b) whose texts are similar; a centre ``a`` of many pairs is dealt over ``deal`` tasks."""
    dealt = cut(pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.col("deal")).cast("int")).drop("deal"))
    left = dealt.select("a", "salt").distinct().join(texts, F.col("a") == texts["__id"]).select("a", "salt", F.col("text").alias("ta"))
    both = dealt.join(texts.select(F.col("__id").alias("b"), F.col("text").alias("tb")), "b").join(left, ["a", "salt"]).select("a", "b", "ta", "tb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tb"):
            for part in slices([batch], "ta"):
                ok = pa.array(similarity(part.column("ta"), part.column("tb"), idf.value) >= least)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], names=["a", "b"])

    return cut(both.mapInArrow(tidy(verify), "a long, b long"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Node and the least node of its component, for every node of ``edges`` (a, b) that is not the least itself, by alternating star contraction."""
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node joins the node's least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours join the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components need more rounds")
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


def _candidates(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from buckets (key, id): centre a, other b and the tasks that the centre is dealt over; and the large buckets' members (key, id, n).

    Rows here are a few numbers wide; a hot key of the joins is split by adaptive execution.
    """
    stats = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("c1"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("c2")).where("n > 1")
    members = cut(keys.join(stats, "key"))
    few = members.where(F.col("n") <= SMALL).groupBy("key").agg(F.collect_list("id").alias("ids"))
    pairs = few.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b"), F.lit(1).alias("deal")).where("a < b")
    large = members.where(F.col("n") > SMALL)
    if large.isEmpty():
        return pairs.distinct(), large.select("key", "id", "n")
    large = cut(large.join(large.groupBy("id").agg(F.sum("n").alias("company")), "id"))
    most = large.groupBy("key").agg(F.max(F.struct("company", "id"))["id"].alias("c3"))
    stars = large.join(most, "key").select(F.explode(F.array_distinct(F.array("c1", "c2", "c3"))).alias("a"), F.col("id").alias("b"), (F.floor(F.col("n") / SPREAD) + 1).cast("int").alias("deal"))
    low, high = F.least("a", "b"), F.greatest("a", "b")
    one = pairs.unionByName(stars.where("a <> b")).groupBy(low.alias("low"), high.alias("high")).agg(F.max(F.struct("deal", "a")).alias("x"))
    return one.select("x.a", F.when(F.col("x.a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"), "x.deal"), large.select("key", "id", "n")


def _spread(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """``left`` with many rows of one ``key`` joined to few of ``right``, dealt over ``SALT`` tasks a key by ``by``."""
    salted = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALT)).cast("int")).join(salted, [key, "__salt"]).drop("__salt")


def _features(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, 64-bit feature and weight, and each text's total weight.

    A shingle of count n is n features, the k-th of which has the weight that the k-th occurrence adds;
    so the lesser of two weights of a shingle is the weight of the features that both texts have.
    """
    row, s, tf = shingles(texts)
    at = np.repeat(np.arange(len(s)), tf)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(tf) - tf, tf) + 1
    adds = np.where(nth > 1, np.log(nth) - np.log(np.maximum(nth - 1, 1)), 1.0)
    weight = adds * idf[bucket(s)][at]
    return row[at], s[at] | nth.astype(_U64) << _U64(44), weight, np.bincount(row[at], weight, len(texts))


class Block:
    """Texts that are compared with many others."""

    def __init__(self, texts: pa.Array, idf: np.ndarray):
        self.n, self.idf = len(texts), idf
        row, feature, weight, self.total = _features(texts, idf)
        self.known, code = np.unique(feature, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.row, self.weight = row[order], np.zeros(len(self.known))
        self.weight[code] = weight
        self.begin = np.searchsorted(code[order], np.arange(len(self.known) + 1))

    def similarity(self, texts: pa.Array) -> np.ndarray:
        """Weighted Jaccard similarity of every text of the block (rows) and every one of ``texts``."""
        row, feature, _, total = _features(texts, self.idf)
        m, both = len(texts), np.zeros((self.n, len(texts)))
        if len(self.known) and len(feature):
            at = np.searchsorted(self.known, feature)
            at[at == len(self.known)] = 0
            same = self.known[at] == feature
            row, at = row[same], at[same]
        else:
            row, at = row[:0], np.zeros(0, np.int64)
        size = np.diff(self.begin)
        here = np.bincount(at, minlength=len(self.known))
        # a feature that many on both sides have is multiplied as a column; others are counted pair by pair
        wide = np.flatnonzero(size * here > self.n * m / 100)
        place = np.full(len(self.known), -1)
        place[wide] = np.arange(len(wide))
        for lo in range(0, len(wide), WIDE):
            some = wide[lo : lo + WIDE]
            a, b = np.zeros((self.n, len(some))), np.zeros((m, len(some)))
            n = size[some]
            a[self.row[np.repeat(self.begin[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], np.repeat(np.arange(len(some)), n)] = np.repeat(self.weight[some], n)
            mine = (place[at] >= lo) & (place[at] < lo + WIDE)
            b[row[mine], place[at[mine]] - lo] = 1
            both += a @ b.T
        rest = place[at] < 0
        row, at = row[rest], at[rest]
        n = size[at]
        step = 1 << 20
        ends = np.cumsum(n)
        for lo in np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, step), side="right").tolist():
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, side="right"))
            hi = max(hi, lo + 1)
            k = n[lo:hi]
            mine = self.row[np.repeat(self.begin[at[lo:hi]] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
            both += np.bincount(mine * m + np.repeat(row[lo:hi], k), np.repeat(self.weight[at[lo:hi]], k), self.n * m).reshape(self.n, m)
        union = self.total[:, None] + total[None, :] - both
        return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def _apart(large: DataFrame, found: DataFrame, texts: DataFrame, idf: object, least: float) -> DataFrame | None:
    """Links between different components inside large buckets (key, id, n): all members outside a bucket's largest component against all of their buckets."""
    placed = cut(large.join(found, large["id"] == found["node"], "left").select("key", "id", "n", F.coalesce("component", "id").alias("component")))
    groups = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("key")
    main = groups.agg(F.max(F.struct("m", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "main")
    members = cut(_spread(placed, main, "key", "id"))
    outside = members.where("component <> main")
    if outside.isEmpty():
        return None
    # members that stand apart from one component share most of their buckets' members, so they are blocks together
    home = cut(outside.groupBy("id").agg(F.first("component").alias("component"), F.max(F.struct("n", "main"))["main"].alias("home")))
    deals = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / DEAL).cast("int").alias("deal"))
    blocks = cut(_spread(home, deals, "home", "id").select("id", "component", F.xxhash64("home", F.pmod(F.xxhash64("id", F.lit(2)), F.col("deal"))).alias("block")))
    needs = outside.select("key", "id").join(blocks.select("id", "block"), "id").select("key", "block").distinct()
    meets = cut(_spread(members.select("key", "id", "component"), needs, "key", "id").select("block", "id", "component").distinct())
    runs = meets.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("runs"))
    inside = blocks.join(runs, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("role"), "id", "component", F.lit(True).alias("outside"))
    against = _spread(meets, runs, "block", "id").select("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("runs")).cast("int").alias("run"), F.lit(1).alias("role"), "id", "component")
    against = against.join(blocks.select("id", F.lit(True).alias("outside")), "id", "left").select("block", "run", "role", "id", "component", F.coalesce("outside", F.lit(False)).alias("outside"))
    both = inside.unionByName(against).join(texts.select(F.col("__id").alias("id"), "text"), "id")
    both = both.repartition("block", "run").sortWithinPartitions("block", "run", "role", "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block, ids, of = None, [], None, None, None
        for batch in slices(batches, "text"):
            group = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "run", "role")], axis=1)
            begins = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])).tolist()
            for lo, hi in zip(begins, [*begins[1:], len(group)], strict=True):
                part, (b, r, role) = batch.slice(lo, hi - lo), group[lo].tolist()
                if (b, r) != now:
                    now, held, block = (b, r), [], None
                if role == 0:
                    held.append(part)
                    continue
                if block is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    ids, of = whole.column("id").to_numpy(), whole.column("component").to_numpy()
                    block, held = Block(pa.chunked_array(whole.column("text").chunks).combine_chunks(), idf.value), []
                other, to, out = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "component", "outside"))
                ok = (block.similarity(part.column("text")) >= least) & (of[:, None] != to[None, :]) & (~out[None, :] | (ids[:, None] < other[None, :]))
                x, y = np.nonzero(ok)
                # one link between a text of the block and a component is enough
                _, first = np.unique(np.stack([x, to[y]], axis=1), axis=0, return_index=True) if len(x) else (None, np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids[x[first]]), pa.array(other[y[first]])], names=["a", "b"])

    return cut(both.mapInArrow(tidy(compare), "a long, b long"))


def _classed(rows: DataFrame, least: float) -> DataFrame:
    """``rows`` (__id, unique, key and text; stored): __id, key, class_id, class_size and first."""
    spark = rows.sparkSession
    counts, n = _counts(rows)
    idf = spark.sparkContext.broadcast(idf_table(counts, n))
    signed = written(_signatures(rows, idf), "signatures")
    nodes = cut(signed.groupBy("h1", "h2").agg(F.min("__id").alias("node"), F.min_by("bands", "__id").alias("bands")))
    pairs, large = _candidates(nodes.select(F.explode("bands").alias("key"), F.col("node").alias("id")))
    pairs = cut(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("__id")).distinct()
    texts = written(rows.select("__id", "text").join(ids, "__id", "left_semi"), "pairs")  # only texts in pairs are moved again
    links = verified(pairs, texts, idf, least)
    found = cut(components(links))
    more = None if large.isEmpty() else _apart(large, found, texts, idf, least)
    if more is not None and not more.isEmpty():
        found = cut(components(links.unionByName(more)))
    node = nodes.join(found, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component"))
    # a text copied often is a frequent (h1, h2), a large class a frequent component: rows are narrow, and the salt spreads them
    spread = node.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salt = F.pmod("__id", F.lit(SALT)).cast("int")
    named = cut(signed.select("__id", "key", "h1", "h2").withColumn("salt", salt).join(spread, ["h1", "h2", "salt"]).select("__id", "key", "component"))
    sizes = named.groupBy("component").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct(F.col("key").isNull(), "key", "__id"))["__id"].alias("keeps"))
    spread = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    out = named.withColumn("salt", salt).join(spread, ["component", "salt"])
    return out.select("__id", "key", "class_id", "class_size", (F.col("__id") == F.col("keeps")).alias("first"))


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """Per row: key, class_id (the class's least key), class_size, and first (this row stays of its class)."""
    rows = written(documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("__id", F.monotonically_increasing_id()), "texts")
    return _classed(rows, least).select(F.col("key").alias(key), "class_id", "class_size", "first")


def representatives(documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """One whole row of ``documents`` for each class: that of the least key."""
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != text), F.col(f"`{text}`").isNull().alias("__null")).alias("row")
    rows = written(documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), whole).withColumn("__id", F.monotonically_increasing_id()), "texts")
    kept = rows.join(_classed(rows, least).where("first").select("__id"), "__id", "left_semi")
    own = F.when(~F.col("row.__null"), F.col("text")).cast(documents.schema[text].dataType).alias(text)
    return kept.select(*(own if c == text else F.col("row")[c].alias(c) for c in documents.columns))
