"""Corpus preparation in five stages, each a table of documents that the next one reads.

    quality          documents that the classifier rejects go
    near_duplicates  one document of each group of near copies stays
    decontaminate    documents that hold a benchmark window go
    mix              sources are mixed to target weights, whole documents once, twice or not
    token_store      token ids are written in coded files and read back; one row a document

The classifier learns from the labelled rows of its input. Each stage but the last
returns the columns of ``documents``.

Null and empty texts score by the classifier's intercept like any other text; they are no copies of anything, hold no
benchmark words, have size 0 and so are taken as often as the mix repeats their source as a whole, and have only the end id. Null ids and sources are values of their own. Rows that repeat are copies
of each other, so one of them stays. Of ties the least id stays in near_duplicates, and the order of two hashes of id and text decides in mix.
An empty table gives an empty result; extra columns go along to the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.llm import decontaminate, mixing, neardup, quality, token_store
from seqframe.llm.common import shared_folder, table

#: Documents score at least this to be kept.
KEEP_SCORE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least KEEP_SCORE."""
    columns = docs.columns
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), quality.crc("doc_id", 5) != 0)
    scored = quality.score(docs, weights, name="__score")
    return scored.filter(F.col("__score") >= KEEP_SCORE).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of least id."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def store_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (doc_id, start, n_tokens, ids_crc32) a document, read back from the coded files."""
    return token_store.store_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("token_store", store_token_ids),
]

#: SQL can't express the trained classifier, so there is none for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
