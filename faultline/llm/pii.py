"""Personal data: fixed patterns, and bootstrapped patterns that find identifiers they miss. SQL expressions only.

Base kinds (email, ip, card, phone) are regular expressions with a check. Spark gives the matches of
an expression and the text between them, so a running sum of lengths gives code-point offsets.

Seeds are all base spans and the matches of ``SEEDS`` (secrets of known formats, spans of their own).
In a second text every seed is one character, so that a seed is a token like any other, and tokens
are what stands between white space. A token has a value (without the marks around it, and without
what stands before the last of the marks ``= : " ' ( < [ {``), and a context: what was cut off before
the value, and unless that has a letter, the last word left of it, with the marks between.

Bootstrapping, in rounds. (1) The contexts of at least ``least_seeds`` different seeds are patterns.
(2) Patterns of which seeds are at least ``least_share`` of all occurrences are followed: whatever
else stands in such a context is a candidate, whatever its characters. (3) Patterns, and shapes (kinds
of characters, length) of seeds and candidates, form a graph with the values. A pattern scores the
share of seeds among its distinct values (shrunk towards 0 when they are few), a candidate the mean of its
patterns, weighted by the logarithm of their size. (4) Candidates of a high score with a high-scoring
pattern are found, unless over nine tenths of their occurrences are in other contexts, as with common words. They are
of the kind that most of the pattern's seeds have; every occurrence is a span, and a seed of the next round,
so scores change from round to round. It ends when a round finds nothing, or after ``rounds``.

Tokens are not shuffled but counted and filtered in the task that reads their text from a table in the
shared folder, by a join with the keys of the contexts, which are broadcast only up to ``MOST_KEYS``. Sums by pattern are pre-aggregated, joins on a frequent pattern are
salted.

Nulls: a null text is empty, other columns may be null and keep their values; repeated rows have
equal results (each counts once in distinct pairs); ties between kinds go to the last in the alphabet;
very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import cut, written

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"[0-9]++(?:\.[0-9]++){3}"
#: In card texts a single space or hyphen between two digits is U+E000 first: no nested repetition is left.
MARK, OTHER = "\ue000", "\ue001"
CARD = f"[0-9][0-9{MARK}]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
#: Stands for a seed, and for a character of the text that is equal to it.
SEED, NO_SEED = "\ue002", "\ue003"
#: Further seed entities: expressions of whole tokens (a public key-id format, a 160-bit hex value).
SEEDS = {"secret": ("AKIA[A-Z0-9]{16}", "[0-9a-f]{40}")}
#: Values of which a check of a base kind has decided that they are none.
REFUTED = r"^(?:[0-9]{13,19}|[0-9]+(?:\.[0-9]+){3})$"
INSIDE = rf"\p{{L}}\p{{N}}{SEED}"
#: Marks that end what is cut off before a value.
MARKS = r"""[=:"'(<\[{]"""
#: Most contexts that are broadcast (beyond that every token's context is made and joined), and most words that texts are searched for first.
MOST_KEYS, FEW = 100_000, 50
SPAN = "struct<kind:string,s:int,e:int>"
SALT = 16


def _quoted(regex: str) -> str:
    return regex.replace("\\", "\\\\").replace("'", "\\'")


def matches(text: str, regex: str, guard: str) -> str:
    """SQL for array<struct<m, s, e>> of an expression's matches in a text column; ``guard`` is a cheap necessary condition."""
    r = _quoted(regex)
    return f"""if({guard}, aggregate(
        arrays_zip(split({text}, '{r}', -1), regexp_extract_all({text}, '{r}', 0)),
        named_struct('at', 0, 'out', cast(array() as array<struct<m:string,s:int,e:int>>)),
        (a, x) -> named_struct('at', a.at + char_length(x.`0`) + coalesce(char_length(x.`1`), 0),
            'out', if(x.`1` is null, a.out, array_append(a.out, named_struct('m', x.`1`, 's', a.at + char_length(x.`0`), 'e', a.at + char_length(x.`0`) + char_length(x.`1`))))),
        a -> a.out), cast(array() as array<struct<m:string,s:int,e:int>>))"""


def _luhn(digits: str) -> str:
    return f"""aggregate(sequence(1, char_length({digits})), 0L, (t, i) -> t + if(i % 2 = 1,
        cast(substr({digits}, -i, 1) as bigint),
        (2 * cast(substr({digits}, -i, 1) as bigint)) div 10 + (2 * cast(substr({digits}, -i, 1) as bigint)) % 10)) % 10 = 0"""


def scan(documents: DataFrame, text: str = "text", seeds: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``documents`` with ``__base`` (base spans by kind, then start), ``__more`` (matches of ``seeds``), ``__seeds``
    (both, without overlaps, by start), their ``__values``, and ``__m`` (the text with one character for each seed)."""
    df = documents.withColumn("__t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    # U+E000 joins digits in the card text; where a text has that character, U+E001 stands for it
    marked = f"regexp_replace(translate(__t, '{MARK}', '{OTHER}'), '(?<=[0-9])[ -](?=[0-9])', '{MARK}')"
    df = df.withColumn("__c", F.expr(f"if(rlike(__t, '[0-9](?:[ -]?[0-9]){{12}}'), {marked}, '')"))
    digits = f"replace(x.m, '{MARK}', '')"
    kept = {
        "email": ("__t", EMAIL, "contains(__t, '@')", "true"),
        "ip": ("__t", IP, r"rlike(__t, '[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]')", f"forall(split(x.m, '[.]'), p -> rlike(p, '^{BYTE_PART}$'))"),
        "card": ("__c", CARD, "__c <> ''", f"char_length({digits}) between 13 and 19 and {_luhn(digits)}"),
        "phone": ("__t", PHONE, "contains(__t, '+')", "char_length(regexp_replace(x.m, '[^0-9]', '')) between 9 and 15"),
    }
    parts = [f"transform(filter({matches(column, regex, guard)}, x -> {check}), x -> named_struct('kind', '{kind}', 's', x.s, 'e', x.e))" for kind, (column, regex, guard, check) in kept.items()]
    df = df.withColumn("__base", F.expr(f"concat({', '.join(parts)})"))
    rules = SEEDS if seeds is None else seeds
    edge = "[A-Za-z0-9_-]"
    more = [f"transform({matches('__t', f'(?<!{edge})(?:{r})(?!{edge})', f"rlike(__t, '{_quoted(r)}')")}, x -> named_struct('kind', '{kind}', 's', x.s, 'e', x.e))" for kind, rs in rules.items() for r in rs]
    none = f"cast(array() as array<{SPAN}>)"
    df = df.withColumn("__more", F.expr(f"filter(concat({', '.join([none, *more])}), x -> not exists(__base, b -> b.s < x.e and x.s < b.e))"))
    # of spans that overlap, the first (and longest) one is the seed's character
    df = df.withColumn("__seeds", F.expr(f"""if(size(__base) + size(__more) = 0, {none}, aggregate(
        array_sort(concat(__base, __more), (a, b) -> case when a.s <> b.s then a.s - b.s when a.e <> b.e then b.e - a.e when a.kind < b.kind then -1 when a.kind > b.kind then 1 else 0 end),
        {none}, (a, x) -> if(size(a) > 0 and x.s < element_at(a, -1).e, a, array_append(a, x))))"""))
    clean = f"translate(__t, '{SEED}', '{NO_SEED}')"
    df = df.withColumn("__m", F.expr(f"""if(size(__seeds) = 0, {clean}, aggregate(__seeds, named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct('at', x.e, 'out', concat(a.out, substr({clean}, a.at + 1, x.s - a.at), '{SEED}')), a -> concat(a.out, substr({clean}, a.at + 1))))"""))
    df = df.withColumn("__values", F.expr("transform(__seeds, x -> substr(__t, x.s + 1, x.e - x.s))"))
    return df.drop("__t", "__c")


def _plain(text: str) -> str:
    """Lower case, with 0 for every digit."""
    return f"regexp_replace(lower({text}), '[1-9]', '0')"


def _shape(value: str) -> str:
    kinds = {"a": "[a-z]", "A": "[A-Z]", "9": "[0-9]", "-": "[_-]", ".": "[^A-Za-z0-9_-]"}
    return f"concat({', '.join(f"if(rlike({value}, '{r}'), '{k}', '')" for k, r in kinds.items())}, ':', char_length({value}))"


#: Key of a context: the token before, or one key for all tokens with a mark inside.
KEY = f"if(rlike(x, '{_quoted(f"[{INSIDE}][^{INSIDE}]+[{INSIDE}]")}'), '*', {_plain('b')})"
SPLIT = "split({}, '\\\\s', -1)"


def tokens(stored: DataFrame, row: str) -> DataFrame:
    """``row``, i (number of white space characters before it), and the token x with the two before it, b and a."""
    parts = stored.select(row, F.expr(SPLIT.format("__m")).alias("p"))
    return parts.select(row, F.explode(F.expr("transform(p, (x, i) -> named_struct('i', i, 'a', coalesce(get(p, i - 2), ''), 'b', coalesce(get(p, i - 1), ''), 'x', x))")).alias("t")).select(row, "t.*").where("x <> ''")


def _holding(stored: DataFrame, words: list[str], digits: bool) -> DataFrame:
    """The rows whose texts may have one of ``words``, if these are few; it only saves work. ``digits``: 0 stands for any digit."""
    if len(words) > FEW or "" in words:
        return stored
    if not digits:
        return stored.where(F.expr(" or ".join(f"contains(__m, '{_quoted(w)}')" for w in words)))
    escaped = ["".join(c if c.isalnum() else "\\" + c for c in w) for w in words]
    return stored.where(F.expr(f"rlike(__m, '{_quoted(f'(?iu)(?:{"|".join(w.replace("0", "[0-9]") for w in escaped)})')}')"))


def near(stored: DataFrame, row: str, contexts: DataFrame, values: bool) -> DataFrame:
    """Tokens in ``contexts`` (context, key; stored): their context, and with ``values`` their description."""
    bounded = [tuple(r) for r in contexts.select("context", "key").distinct().limit(MOST_KEYS + 1).collect()]
    if len(bounded) > MOST_KEYS:  # no key is used, nothing is broadcast
        return described(tokens(stored, row)).join(contexts.select("context").distinct(), "context", "left_semi")
    wanted = F.broadcast(contexts.select("context").distinct())
    keys = sorted({k for _, k in bounded})
    own, glued = [k for k in keys if k != "*"], "*" in keys
    found = []
    if own:
        # what is read from this table ("none" is always empty) keeps costly expressions behind the join
        table = cut(stored.sparkSession.createDataFrame([(k, "", any(c.isalnum() or c == SEED for c in k), k + " ") for k in own], "key string, none string, wordy boolean, after string"))
        plain = F.expr(SPLIT.format(_plain("__m"))).alias("q")
        # contexts are lower case, so where values are not asked for, the plain text is enough
        parts = _holding(stored, own, True).select(row, plain, (F.expr(SPLIT.format("__m")) if values else plain).alias("p"))
        after = parts.select(row, "p", F.posexplode("q").alias("pos", "key")).join(F.broadcast(table), "key")
        taken = after.select(row, F.expr("pos + 1").alias("i"), *(F.expr(f"concat(none, coalesce(get(p, pos + {k}), ''))").alias(c) for c, k in (("a", -1), ("b", 0), ("x", 1))), "wordy", "after").where("x <> ''")
        # most tokens begin with a letter, hold no mark, and stand after a word
        cheap = F.col("wordy") & F.expr("(ascii(x) between 48 and 57 or ascii(x) between 65 and 90 or ascii(x) between 97 and 122)") & ~F.expr(f"rlike(x, '{_quoted(MARKS)}')")
        found.append(described(taken, F.when(cheap, F.col("after"))))
        if "" in own:  # nothing stands before a text's first token
            found.append(described(parts.select(row, F.lit(0).alias("i"), F.lit("").alias("a"), F.lit("").alias("b"), F.expr("p[0]").alias("x")).where("x <> ''")))
    if glued:
        rest = tokens(stored, row).where(F.expr(KEY) == "*")
        found.append(described(rest.where(~F.expr(_plain("b")).isin(own)) if own else rest))
    columns = [row, "i", "b", "x", "open", "value", "context"] if values else ["context"]
    both = found[0].select(*columns)
    for f in found[1:]:
        both = both.unionByName(f.select(*columns))
    return both.join(wanted, "context", "left_semi")


def described(found: DataFrame, known: Column | None = None) -> DataFrame:
    """Tokens with ``open`` (what is cut off before the value), ``value`` and ``context`` (``known``, where it is not null).

    Lambda functions keep the generated code of a stage small: methods beyond 8000 bytes would not be compiled.
    """
    word = _quoted(f"[{INSIDE}]")
    before = rf"""^(?:.*{MARKS})?[^{INSIDE}]*"""
    simple = rf"""^[{INSIDE}][^{MARKS[1:]}*+$"""  # most tokens: nothing is cut off before the value
    strip = f"'[^{_quoted(INSIDE)}]+$', ''"
    opening = f"if(rlike(x, '{_quoted(simple)}'), '', regexp_extract(regexp_replace(x, {strip}), '{_quoted(before)}', 0))"
    context = _plain(f"case when o <> '' and rlike(o, '{word}') then o when rlike(b, '{word}') then concat(b, ' ', o) else concat(a, ' ', b, ' ', o) end")
    context = F.coalesce(F.expr(f"transform(array({opening}), o -> {context})[0]"), F.lit(""))
    df = found.withColumn("context", context if known is None else F.coalesce(known, context))
    df = df.withColumn("open", F.coalesce(F.expr(f"transform(array(x), x -> {opening})[0]"), F.lit("")))
    return df.withColumn("value", F.expr(f"regexp_replace(substr(x, char_length(open) + 1), {strip})"))


def _score(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns (pattern, n, p) and of values (value, score), from edges (pattern, value, seed, salt)."""
    known = F.count_if(F.col("seed").isNotNull())
    patterns = cut(edges.groupBy("pattern").agg(known.alias("t"), F.count(F.lit(1)).alias("n")).select("pattern", "n", (F.col("t") / (F.col("n") + 2)).alias("p")))
    spread = patterns.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    weight = F.when(F.col("pattern").startswith("L:"), F.log2(F.col("n") + 1)).otherwise(1.0)
    # sums in whole millionths do not depend on their order
    scored = edges.join(spread, ["pattern", "salt"]).groupBy("value").agg((F.sum(F.rint(F.col("p") * weight * 1e6).cast("long")) / F.sum(F.rint(weight * 1e6).cast("long"))).alias("score"))
    return patterns, cut(scored)


def bootstrap(stored: DataFrame, row: str, rounds: int = 3, least_seeds: int = 5, least_share: float = 0.2, own_share: float = 0.1, pattern_score: float = 0.8, score: float = 0.7) -> DataFrame:
    """Per row with discoveries: ``row`` and ``__new``, their spans.

    ``stored`` is a table of :func:`scan`'s rows in the shared folder, with ``row``, unique.
    """
    none = f"cast(array() as array<{SPAN}>)"
    some = stored.where(F.size("__seeds") > 0)
    # the k-th seed's character of a text is the k-th seed
    counted = some.select(row, F.expr("arrays_zip(__seeds, __values)").alias("z"), F.expr(f"split(__m, '\\\\s', -1)").alias("p"))
    at = counted.select(row, "z", F.explode(F.expr(f"filter(transform(p, (x, i) -> named_struct('i', i, 'a', coalesce(get(p, i - 2), ''), 'b', coalesce(get(p, i - 1), ''), 'x', x, 'k', if(contains(x, '{SEED}'), char_length(regexp_replace(array_join(slice(p, 1, i), ''), '[^{SEED}]', '')), 0))), t -> contains(t.x, '{SEED}'))")).alias("t")).select(row, "z", "t.*")
    known = described(at).where(F.expr(f"value = '{SEED}'")).select(F.expr("z[k].__seeds.kind").alias("seed"), F.expr("z[k].__values").alias("value"), "context", F.expr(KEY).alias("key"))
    seeds = cut(known.groupBy("context", "key", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times")))
    found = None
    for _ in range(rounds):
        patterns = cut(seeds.groupBy("context").agg(F.count_distinct("value").alias("seeds"), F.sum("times").alias("times")).where(F.col("seeds") >= least_seeds))
        if patterns.isEmpty():
            break
        contexts = cut(seeds.join(patterns, "context", "left_semi").select("context", "key").distinct())
        every = near(stored, row, contexts, False).groupBy("context").agg(F.count(F.lit(1)).alias("all"))
        followed = cut(patterns.join(every, "context").where(F.col("times") >= F.col("all") * least_share).select("context"))
        contexts = cut(contexts.join(followed, "context", "left_semi"))
        if contexts.isEmpty():
            break
        others = cut(near(stored, row, contexts, True).select("context", "value")).where(f"value <> '' and not contains(value, '{SEED}')").groupBy("context", "value").agg(F.lit(None).cast("string").alias("seed"))
        graph = seeds.join(followed, "context", "left_semi").select("context", "value", "seed").unionByName(others).groupBy("context", "value").agg(F.max("seed").alias("seed"))
        edges = graph.select(F.explode(F.array(F.concat(F.lit("L:"), "context"), F.concat(F.lit("S:"), F.expr(_shape("value"))))).alias("pattern"), "value", "seed")
        edges = cut(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")).withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALT)).cast("int")))
        scores, values = _score(edges)
        kinds = edges.where("seed is not null").groupBy("pattern", "seed").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern").agg(F.max_by("seed", F.struct("n", "seed")).alias("kind"), F.sum("n").alias("seeds"))
        bounded = followed.limit(MOST_KEYS + 1).collect()
        good = scores.where((F.col("p") >= pattern_score) & F.col("pattern").startswith("L:")).join(kinds.where(F.col("seeds") >= least_seeds), "pattern").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        new = edges.where(F.col("seed").isNull() & ~F.col("value").rlike(REFUTED)).join(good, ["pattern", "salt"]).groupBy("value").agg(F.max_by("kind", F.struct("p", "kind")).alias("kind"))
        new = cut(new.join(values.where(F.col("score") >= score), "value").select("value", "kind"))
        shortest = new.agg(F.min(F.char_length("value"))).first()[0]
        if shortest is None:
            break
        # every occurrence of what was found: spans, and seeds of the next round
        names = [r[0] for r in new.select("value").limit(MOST_KEYS + 1).collect()]
        long = tokens(_holding(stored, names, False), row).where((F.char_length("x") >= shortest) & ~F.contains("x", F.lit(SEED)))
        hits = cut(described(long).join(F.broadcast(new) if len(names) <= MOST_KEYS else new, "value").select(row, "i", F.char_length("open").alias("o"), "value", "kind", "context", F.expr(KEY).alias("key")))
        inside = F.broadcast(good.select(F.expr("substr(pattern, 3)").alias("context"), F.lit(1).alias("in")).distinct()) if len(bounded) <= MOST_KEYS else good.select(F.expr("substr(pattern, 3)").alias("context"), F.lit(1).alias("in")).distinct()
        own = hits.join(inside, "context", "left").groupBy("value").agg((F.count("in") / F.count(F.lit(1))).alias("share")).where(F.col("share") >= own_share)
        hits = cut(hits.join(own.select("value"), "value", "left_semi"))
        if hits.isEmpty():
            break
        found = hits if found is None else found.unionByName(hits)
        seeds = cut(seeds.unionByName(hits.groupBy("context", "key", "value").agg(F.max("kind").alias("seed"), F.count(F.lit(1)).alias("times"))).groupBy("context", "key", "value").agg(F.max("seed").alias("seed"), F.max("times").alias("times")))
    if found is None:
        return stored.select(row, F.expr(none).alias("__new")).where("false")
    # only texts with discoveries are read again
    hits = cut(found.groupBy(row, "i").agg(F.max(F.struct("kind", "value", "o")).alias("h")))
    small = F.broadcast if hits.count() <= MOST_KEYS else lambda df: df
    texts = stored.select(row, "__m", "__seeds").join(small(hits.select(row).distinct()), row, "left_semi")
    place = "aggregate(slice(split(__m, '\\\\s', -1), 1, i), 0, (n, x) -> n + char_length(x) + 1) + h.o"
    placed = texts.join(small(hits), row).withColumn("s", F.expr(f"aggregate(__seeds, {place}, (n, x) -> if(x.s < n, n + x.e - x.s - 1, n))"))
    span = F.struct(F.col("h.kind").alias("kind"), F.col("s").cast("int").alias("s"), (F.col("s") + F.char_length("h.value")).cast("int").alias("e"))
    return small(cut(placed.groupBy(row).agg(F.array_sort(F.collect_list(span)).alias("__new"))))


def all_spans(documents: DataFrame, text: str = "text", keep_text: bool = False, seeds: dict[str, tuple[str, ...]] | None = None, **parameters: object) -> DataFrame:
    """``documents`` (without ``text``, unless it is kept) with ``__base`` and ``__more`` (further seeds and discoveries)."""
    found = scan(documents.withColumn("__row", F.monotonically_increasing_id()), text, seeds)
    stored = written(found if keep_text else found.drop(text), "pii")
    new = bootstrap(stored, "__row", **parameters)  # type: ignore[arg-type]
    out = stored.drop("__m", "__values", "__seeds").join(new, "__row", "left")
    return out.withColumn("__more", F.expr("if(__new is null, __more, concat(__more, __new))")).drop("__new", "__row")


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, a count for each base kind, the digest of the base spans, and all spans."""
    found = all_spans(documents.select(key, text), text)
    rank = "cast(coalesce(nullif(array_position(array({}), {}.kind), 0), {}) as int)"
    a, b = (rank.format(", ".join(map(repr, KINDS)), x, len(KINDS) + 1) for x in "ab")
    order = F.expr(f"array_sort(concat(__base, __more), (a, b) -> case when {a} <> {b} then {a} - {b} when a.kind < b.kind then -1 when a.kind > b.kind then 1 else a.s - b.s end)")
    counts = [F.expr(f"cast(size(filter(__base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select(key, *counts, F.sha2(joined(F.col("__base")).cast("binary"), 256).alias("base_sha256"), joined(order).alias("spans"))


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with every span replaced by its kind in angle brackets; spans that overlap are one, of the first's kind."""
    rest = F.struct(F.lit(True).alias("__"), *(F.col(f"`{c}`") for c in documents.columns if c != text)).alias("all")
    found = all_spans(documents.select(rest, F.col(text).cast("string").alias("text")), "text", keep_text=True)
    spans = "array_sort(concat(__base, __more), (a, b) -> case when a.s <> b.s then a.s - b.s else b.e - a.e end)"
    made = f"""if(size(__base) + size(__more) = 0, text, aggregate({spans},
        named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct('at', greatest(a.at, x.e),
            'out', if(x.s < a.at, a.out, concat(a.out, substr(text, a.at + 1, x.s - a.at), '<', upper(x.kind), '>'))),
        a -> concat(a.out, substr(text, a.at + 1))))"""
    return found.select(*(F.expr(made).alias(c) if c == text else F.col("all")[c].alias(c) for c in documents.columns))
