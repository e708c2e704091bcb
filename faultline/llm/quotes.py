"""Quotation linking: which message does a quote come from, and conversations in reply order. SQL expressions only.

A line's quote level is the number of ``>`` marks before its text. Neighbouring lines of one level
are a passage. Passages and lines are normalised (lower case, only letters and digits, single
spaces) and hashed; hashes of unquoted ones are the index, one row for each hash: the first message
that has it, in its conversation and overall. Every quoted passage joins the index by its hash, or
else by the hashes of its lines; the conversation's own first message wins if it is earlier than the
quoting one, else the first message of all. A message's parent is the origin of its first passage of
the least level. Parents in the same conversation make threads; their roots come from pointer
doubling. The order of a conversation is that of thread roots, then of turns, so a reply follows its
parent, and texts are rid of quotes and of the line that introduces one.

The index has one row a hash, and of it only hashes that somebody quotes are joined; those quoted often are
salted, so a passage that everybody quotes is no hot
key; positions come from a global range sort, so nor is a very long conversation.

Nulls: a null text is empty; rows of a null conversation or turn keep null as such (nulls are equal,
and a null turn is before all others); repeated rows have equal results but for their position; an
empty table gives an empty result; other columns than the four named are not read. Conversations and turns
are whole numbers (a text that is no number fails, as a cast does); a very long text is parsed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import cut
from faultline.llm.sharding import numbered

SALT = 16
#: Quotes of one hash from which on it is salted.
OFTEN = 1000
INTRODUCTION = "^.{0,200}(?:wrote|writes|schrieb|a écrit|escribió) ?:\\\\s*$"
QUOTE = "^[ \\\\t]{0,3}>[> \\\\t]*"


def _norm(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"


def parse(messages: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__passages``: array of struct(level, lines), in order, and ``clean``, the text without quotes."""
    df = messages.withColumn("__lines", F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\r?\n"))
    marks = f"regexp_extract(l, '{QUOTE}', 0)"
    df = df.withColumn("__lines", F.expr(f"transform(__lines, l -> named_struct('level', char_length(regexp_replace({marks}, '[^>]', '')), 'body', substr(l, char_length({marks}) + 1), 'raw', l))"))
    # places where the level changes; a passage goes from one to before the next
    df = df.withColumn("__starts", F.expr("filter(sequence(1, size(__lines)), i -> i = 1 or __lines[i - 1].level <> __lines[i - 2].level)"))
    df = df.withColumn("__passages", F.expr("transform(__starts, (s, k) -> named_struct('level', __lines[s - 1].level, 'lines', transform(slice(__lines, s, coalesce(get(__starts, k + 1), size(__lines) + 1) - s), x -> x.body)))"))
    own = f"filter(__lines, (x, i) -> x.level = 0 and not (coalesce(get(__lines, i + 1).level, 0) > 0 and rlike(x.raw, '{INTRODUCTION}')))"
    df = df.withColumn("clean", F.expr(f"trim(BOTH '\n' FROM array_join(transform({own}, x -> x.raw), '\n'))"))
    return df.drop("__lines", "__starts")


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", keep: tuple[str, ...] = ("role",)) -> DataFrame:
    """Per message: conv, turn, kept columns, clean, n_quotes, max_level, n_linked, parent_conv, parent_turn, root_turn and position."""
    rows = messages.select(F.col(conv).cast("long").alias("c"), F.col(turn).cast("long").alias("t"), *keep, F.col(text).alias("__text")).withColumn("__id", F.monotonically_increasing_id())
    parsed = cut(parse(rows, "__text").drop("__text"))
    passages = parsed.select("__id", "c", "t", F.posexplode("__passages").alias("p", "x")).select("__id", "c", "t", "p", "x.level", "x.lines")
    whole = _norm("array_join(lines, ' ')")
    each = f"transform(filter(transform(lines, l -> {_norm('l')}), n -> n <> ''), n -> named_struct('kind', 1, 'h', xxhash64(n)))"
    hashes = F.expr(f"if({whole} = '', cast(array() as array<struct<kind:int,h:bigint>>), array_union(array(named_struct('kind', 0, 'h', xxhash64({whole}))), {each}))")
    hashed = passages.withColumn("h", F.explode(hashes)).select("__id", "c", "t", "p", "level", "h.kind", "h.h")
    quoted = cut(hashed.where("level > 0").withColumn("salt", F.pmod("__id", F.lit(SALT)).cast("int")))
    # only hashes that somebody quotes are kept of the index, and only those that many quote are salted
    asked = cut(quoted.groupBy("h").agg(F.when(F.count(F.lit(1)) > OFTEN, SALT).otherwise(1).alias("of")))
    own = hashed.where("level = 0").join(asked, "h")
    quoted = quoted.join(asked.withColumnRenamed("h", "a_h").where("of > 1").select("a_h", "of"), F.col("h") == F.col("a_h"), "left").withColumn("salt", F.when(F.col("of") > 1, F.col("salt")).otherwise(0)).drop("a_h", "of")
    salts = F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("salt")
    inside = own.groupBy("c", "h").agg(F.min("t").alias("in_t"), F.first("of").alias("of"))
    overall = own.groupBy("h").agg(F.min(F.struct("c", "t")).alias("o"), F.first("of").alias("of"))
    inside, overall = inside.select(F.col("c").alias("in_c"), F.col("h").alias("in_h"), "in_t", salts), overall.select(F.col("h").alias("o_h"), "o", salts)
    found = quoted.join(inside, (quoted["c"].eqNullSafe(inside["in_c"])) & (quoted["h"] == inside["in_h"]) & (quoted["salt"] == inside["salt"]), "left").drop(inside["salt"])
    found = found.join(overall, (found["h"] == overall["o_h"]) & (found["salt"] == overall["salt"]), "left").drop(overall["salt"])
    here, other = F.col("in_t") < F.col("t"), F.col("o").isNotNull() & ~(F.col("o.c").eqNullSafe(F.col("c")))
    found = found.withColumn("to", F.when(here, F.struct("c", F.col("in_t").alias("t"))).when(other, F.struct(F.col("o.c").alias("c"), F.col("o.t").alias("t"))))
    best = found.groupBy("__id", "p").agg(F.first("level").alias("level"), F.min_by("to", F.when(F.col("to").isNotNull(), F.struct("kind", "to"))).alias("to"))
    per = best.groupBy("__id").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.max("level").cast("long").alias("max_level"), F.count("to").alias("n_linked"),
        F.min_by("to", F.when(F.col("to").isNotNull(), F.struct("level", "p"))).alias("to"),
    )
    # messages without quotes have no row in per
    out = parsed.drop("__passages").join(per, "__id", "left").fillna(0, ["n_quotes", "max_level", "n_linked"])
    out = cut(out.withColumn("parent_conv", F.col("to.c")).withColumn("parent_turn", F.col("to.t")).drop("to"))
    roots = _roots(out.where(F.col("parent_turn").isNotNull() & F.col("parent_conv").eqNullSafe(F.col("c"))).select("c", "t", F.col("parent_turn").alias("up")).groupBy("c", "t").agg(F.min("up").alias("up")))
    roots = roots.select(F.col("c").alias("r_c"), F.col("t").alias("r_t"), F.col("up").alias("root_turn"))
    out = out.join(roots, out["c"].eqNullSafe(roots["r_c"]) & out["t"].eqNullSafe(roots["r_t"]), "left").drop("r_c", "r_t")
    out = out.withColumn("root_turn", F.coalesce("root_turn", "t"))
    ranked, _ = numbered(out, ["c", "root_turn", "t", "__id"])
    first = ranked.groupBy("c").agg(F.min("row_number").alias("begin")).select(F.col("c").alias("f_c"), "begin", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    ranked = ranked.withColumn("salt", F.pmod("__id", F.lit(SALT)).cast("int"))
    out = ranked.join(first, ranked["c"].eqNullSafe(first["f_c"]) & (ranked["salt"] == first["salt"]))
    return out.select(F.col("c").alias(conv), F.col("t").alias(turn), *keep, "clean", "n_quotes", "max_level", "n_linked", "parent_conv", "parent_turn", "root_turn", (F.col("row_number") - F.col("begin")).alias("position"))


def _roots(up: DataFrame, rounds: int = 64) -> DataFrame:
    """(c, t, up) with up moved to the end of its chain; a chain halves in every round, and turns fall along it."""
    up = cut(up)
    for _ in range(rounds):
        over = up.select(F.col("c").alias("o_c"), F.col("t").alias("o_t"), F.col("up").alias("over"))
        step = up.join(over, up["c"].eqNullSafe(over["o_c"]) & (up["up"] == over["o_t"]), "left")
        if step.where("over is not null").isEmpty():
            return up
        up = cut(step.select("c", "t", F.coalesce("over", "up").alias("up")))
    raise RuntimeError("chains of replies need more rounds")
