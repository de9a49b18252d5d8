"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.
No stage is expressible in SQL (``ORACLE_SQL`` is None): a learnt model, sketches, edit
distances, keyed surrogates and subword ids; the tests hold each against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.deploy import ship_package
from sparkloom.llm import editmatch, minhash, quality, surrogates, wfst
from sparkloom.llm.common import fresh_path, free_name


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score at least ``quality.THRESHOLD``)."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (that with the smallest id) of each group of near copies: five-word shingles, similarity 0.8 or more."""
    ship_package(spark)
    return minhash.keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return editmatch.without_matches(docs, _table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced; n_chars follows the new text where it counted the old one."""
    old = free_name(docs, "old_text")
    new = surrogates.with_surrogates(docs.withColumn(old, F.col("text")))
    chars = F.when(F.col("n_chars") == F.length(old), F.length("text")).otherwise(F.col("n_chars"))
    return new.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and round_trip of every document."""
    ship_package(spark)
    return wfst.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", replace_pii),
    ("encode", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
