"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, in SQL expressions.

Rows are numbered from 0 in the order of their key. The permutation works on Z_a x Z_b, the
smallest near-square grid with a * b >= n: round by round one coordinate gets a keyed hash of the
other added to it, which is undone by subtraction, so it is a bijection. A value that lands outside
0..n-1 is permuted again (cycle walking); fewer than a values lie outside, so almost no row walks at
all. Shard and slot are remainder and quotient of the permuted number: shard sizes differ by one row
at most, and both can be computed from the row number alone, without the data.

Nulls in the key sort first, rows of one key are ordered by checksum and size (rows equal in all
three are interchangeable), a null text has size 1 and the checksum of no bytes, an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.shared import cut

ROUNDS = 6
#: Steps of the walk that the plan holds; each is needed with probability below 1/sqrt(n).
WALK = 40


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Multiplier and summand of each round, below 2^31, from a linear congruential sequence."""
    out, x = [], seed & 0x7FFFFFFF
    for _ in range(ROUNDS):
        pair = []
        for _ in range(2):
            x = (x * 1103515245 + 12345) % (1 << 31)
            pair.append(x)
        out.append((pair[0] | 1, pair[1]))
    return out


def grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permute_once(x: int, n: int, seed: int) -> int:
    """The permutation of the grid, for one number; tests hold the SQL form against it."""
    a, b = grid(n)
    left, right = x % a, x // a
    for i, (k, c) in enumerate(round_keys(seed)):
        t = (right if i % 2 == 0 else left) * k + c
        t ^= t >> 15
        if i % 2 == 0:
            left = (left + t % a) % a
        else:
            right = (right + t % b) % b
    return right * a + left


def permuted(x: int, n: int, seed: int) -> int:
    x = permute_once(x, n, seed)
    while x >= n:
        x = permute_once(x, n, seed)
    return x


def _step(state: Column, n: int, seed: int) -> Column:
    """``permute_once`` of a number column, as nested structs so that no term is repeated."""
    a, b = grid(n)
    now = F.struct((state % a).cast("long").alias("l"), F.call_function("div", state, F.lit(a)).alias("r"))
    keys = F.array(*(F.struct(F.lit(i % 2 == 0).alias("even"), F.lit(k).cast("long").alias("k"), F.lit(c).cast("long").alias("c")) for i, (k, c) in enumerate(round_keys(seed))))

    def one(s: Column, key: Column) -> Column:
        t = F.when(key["even"], s["r"]).otherwise(s["l"]) * key["k"] + key["c"]
        t = t.bitwiseXOR(F.shiftright(t, 15))
        return F.struct(F.when(key["even"], (s["l"] + t % a) % a).otherwise(s["l"]).alias("l"), F.when(key["even"], s["r"]).otherwise((s["r"] + t % b) % b).alias("r"))

    return F.aggregate(keys, now, one, lambda s: s["r"] * a + s["l"])


def permutation(number: Column, n: int, seed: int) -> Column:
    """Column form of :func:`permuted`; it raises in the event that a walk exceeds ``WALK`` steps."""
    once = _step(number, n, seed)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda x, _: F.when(x < n, x).otherwise(_step(x, n, seed)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("the walk is longer than planned")).cast("long"))


def numbered(rows: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``rows`` with a gapless number from 0 in the given order, and their count.

    Rows are range-partitioned and kept in the shared folder, partitions are counted, and each adds
    the count of those before it: no task holds more than its own range. Only one row for each
    partition (their number is set, not grown by data) is broadcast.
    """
    spark = rows.sparkSession
    tie = [*order, "__tie"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *tie).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = {r[0]: r[1] for r in counts.collect()}  # a row a partition
    total, offsets = 0, []
    for p in sorted(before):
        offsets.append((p, total))
        total += before[p]
    if not offsets:
        return dealt.drop("__tie", "__part").withColumn(name, F.lit(0).cast("long")), 0
    start = F.broadcast(spark.createDataFrame(offsets, "__part int, __start long"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*tie)) - 1
    out = dealt.withColumn("__in", inside).join(start, "__part")
    return out.withColumn(name, F.col("__start") + F.col("__in")).drop("__tie", "__part", "__in", "__start"), total


def shard(documents: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", seed: int = 20240101) -> DataFrame:
    """Per row: key, size, text_crc32, row_number, shard and slot (law ``rows``)."""
    body = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    rows = documents.select(key, (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows, n = numbered(rows, [key, "text_crc32", "size"])
    at = permutation(F.col("row_number"), max(n, 1), seed)
    return rows.withColumn("__at", at).withColumn("shard", (F.col("__at") % shards).cast("int")).withColumn("slot", F.call_function("div", F.col("__at"), F.lit(shards))).drop("__at")
