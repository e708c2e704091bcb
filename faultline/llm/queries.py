"""Queries of the training-data operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import chroma, decontam, minhash, pieces, pii, quotes, sharding, toxicity, warc, wavelet
from faultline.llm.shared import table


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return wavelet.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2)


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages")).where("kind = 'record'")
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op1_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = toxicity.may_learn(F.col("doc_id"))
    model = toxicity.fit(documents, labels.where(learn))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(~learn, F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.7).cast("int").alias("predicted"))


def op6_chroma_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is the score of a recording (a tone for each number); queries: every id divisible by 100.

    ``queries`` has the least id of each matched class of equal query recordings, ``n_matches`` counts all of them."""
    found = chroma.align(table(spark, sf_dir, "embeddings"), F.col("key") % 100 == 0, "vec_id", "embedding", chroma.tune)
    return found.select(F.col("key").alias("vec_id"), "length", "is_query", "n_matches", F.col("matches.query").alias("queries"), F.col("matches.offset").alias("offsets"), F.col("matches.ber").alias("bit_errors"))


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), seed=7)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if (name.startswith("op") or name == "pipeline") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in SQL.items()}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op10_decontamination": rf"""
with item as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
pattern as (
  select distinct item, least(10, len(w)) as size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as p
  from item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
doc as (select row_number() over () as row, doc_id, {_WORDS} as w from documents),
sizes as (select distinct size from pattern),
hit as (
  select row, i, d.size, item
  from (select row, i, size, array_to_string(w[i:i + size - 1], ' ') as p
        from doc, sizes, unnest(range(1, len(w) - size + 2)) as u(i)) d
  join pattern using (size, p)),
word as (select distinct row, k from hit, unnest(range(i, i + size)) as u(k)),
words_hit as (select row, count(*) as n from word group by row),
items as (select row, count(distinct item) as n, string_agg(distinct item, ',' order by item) as list from hit group by row)
select doc_id, len(w) as n_words, coalesce(words_hit.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(words_hit.n, 0) > 0 as contaminated
from doc left join words_hit using (row) left join items using (row)
""",
}


def _permutation_sql(source: str, seed: int = 20240101) -> str:
    """``x`` to ``y``: one pass over the grid, from columns x, a, b."""
    out = f"select *, x % a as l, x // a as r from {source}"
    for i, (k, c) in enumerate(sharding.round_keys(seed)):
        me, other, mod = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        out = f"select * exclude (t) replace (({me} + t % {mod}) % {mod} as {me}) from (select * replace (xor(t, t >> 15) as t) from (select *, {other} * {k} + {c} as t from ({out})))"
    return f"select * exclude (l, r, x), r * a + l as x from ({out})"


#: The table of the CRC-32 used by gzip (polynomial 0xEDB88320), made by its rule.
def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


SQL["op3_feistel_sharding"] = f"""
with recursive crc_table as (select {_crc_table()}::bigint[] as crcs),
sized as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, hex(encode(coalesce(text, ''))) as h from documents),
checked as (
  select doc_id, size, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, size - 1), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::bigint)),
    lambda acc, byte: xor(acc >> 8, crcs[xor(acc, byte) % 256 + 1])), 4294967295::bigint) as text_crc32
  from sized, crc_table),
numbered as (
  select *, row_number() over (order by doc_id, text_crc32, size) - 1 as x, count(*) over () as n from checked),
grid as (select *, cast(floor(sqrt(n - 1)) as bigint) + 1 as a from numbered),
start as (select doc_id, size, text_crc32, n, a, (n + a - 1) // a as b, x, 0 as pass from grid),
walk as (
  select * from start
  union all
  select doc_id, size, text_crc32, n, a, b, x, pass from ({_permutation_sql("(select * replace (pass + 1 as pass) from walk where pass = 0 or x >= n)")}))
select doc_id, size, text_crc32, 'rows' as law, cast(x % 16 as integer) as shard, x // 16 as slot, cast(null as integer) as grown_shard
from walk where pass > 0 and x < n
"""

SQL["op8_warc_salvage"] = """
with page as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
first as (select payload_digest, max(page_id) as id from page where payload_bytes >= 1000 group by all)
select page_id, payload_bytes, payload_digest, if(again, 'revisit', 'response') as record_type, if(again, id, null) as refers_to
from (select *, coalesce(payload_bytes >= 1000 and page_id <> id, false) as again from page left join first using (payload_digest))
"""

SQL["op4_quotation_linking"] = r"""
with recursive msg as (
  select row_number() over () as id, conv_id as c, turn as t, role, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) as ls from conversations),
line as (select id, c, t, i, ls[i] as l, regexp_extract(ls[i], '^[ \t]{0,3}>[> \t]*') as marks from msg, unnest(range(1, len(ls) + 1)) as u(i)),
level as (select id, c, t, i, l, length(regexp_replace(marks, '[^>]', '', 'g')) as level, substr(l, length(marks) + 1) as body from line),
near as (select *, lag(level) over w as before, lead(level) over w as after from level window w as (partition by id order by i)),
part as (select *, sum(cast(level is distinct from before as int)) over (partition by id order by i) as p from near),
norm as (select id, c, t, p, level, i, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) as n from part),
whole as (select id, c, t, p, level, trim(regexp_replace(string_agg(n, ' ' order by i), ' +', ' ', 'g')) as h from norm group by all),
h as (select id, c, t, p, level, 0 as kind, h from whole where h <> '' union all select distinct id, c, t, p, level, 1, n from norm where n <> ''),
inside as (select c, h, min(t) as it from h where level = 0 group by all),
overall as (select h, min((c, t)) as o from h where level = 0 group by all),
found as (select q.id, q.p, q.level, q.kind, case when it < q.t then (q.c, it) when o is not null and o[1] <> q.c then o end as dest
  from h q left join inside i on i.c = q.c and i.h = q.h left join overall a on a.h = q.h where q.level > 0),
best as (select id, p, level, min((kind, dest)) filter (dest is not null) as b from found group by all),
per as (select id, count(*) as n_quotes, max(level) as max_level, count(b) as n_linked, min((level, p, b[2])) filter (b is not null) as x from best group by id),
parent as (select m.id, c, t, role, coalesce(n_quotes, 0) as n_quotes, coalesce(max_level, 0) as max_level, coalesce(n_linked, 0) as n_linked, x[3][1] as parent_conv, x[3][2] as parent_turn from msg m left join per using (id)),
up as (select c, t, min(parent_turn) as up from parent where parent_conv = c group by all),
climb as (select c, t, up from up union all select k.c, k.t, u.up from climb k join up u on u.c = k.c and u.t = k.up),
root as (select c, t, min(up) as root from climb group by all),
clean as (select id, trim(coalesce(string_agg(l, chr(10) order by i) filter (level = 0 and not (coalesce(after, 0) > 0 and regexp_matches(l, '^.{0,200}(?:wrote|writes|schrieb|a écrit|escribió) ?:\s*$'))), ''), chr(10)) as clean from near group by id)
select p.c as conv_id, p.t as turn, role, clean, n_quotes, max_level, n_linked, parent_conv, parent_turn, coalesce(root, p.t) as root_turn,
  row_number() over (partition by p.c order by coalesce(root, p.t), p.t, p.id) - 1 as position
from parent p left join root r on r.c = p.c and r.t = p.t left join clean using (id)
"""
