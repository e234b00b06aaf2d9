"""A corpus pipeline of five stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import common, langid, minhash, mixing, packing, pii
from courtline.llm.catalog import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty or letterless text) go."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, likeness 0.8 or more."""
    return minhash.keep_one(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces' places in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), capacity=4096)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", pack),
]

#: Models and hashed sketches aren't expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows stored as Parquet and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
