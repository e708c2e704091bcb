"""Corpus pipeline: toxicity, near duplicates, decontamination, personal data, sampled pieces.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a
DataFrame; its rows are written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``.

A null or empty text is kept by the filters (it is neither toxic nor contaminated, and all such texts are
one class); null keys, languages and sources are kept as they are; rows that repeat are copies, of which
one stays; columns other than those of ``documents`` are not passed on; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import decontam, minhash, pieces, pii, toxicity
from faultline.llm.shared import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts of at least this score go.
TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier rejects go; labels are learned only from rows that may be learned from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(toxicity.may_learn(F.col("doc_id"))))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("__score") < TOXIC).select(*COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row of the least doc_id stays (of rows that share it, one)."""
    return minhash.representatives(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that have a window of a benchmark item go."""
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where("n_hit = 0").select(*COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars follows the text."""
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each text, seeded by doc_id."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), seed=7, keep=("doc_id", "lang", "source", "n_chars"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("pieces", pieces_stage),
]

#: A classifier, sampled hashes and sampled segmentations are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
