"""The operators' queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import chat, extraction, imatch, langid, licenses, minhash, mixing, oracle, packing, pii, runs, sharding, topk, trie
from courtline.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"), width=3, percent=85)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), weights=(1.0,) * 8)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.as_files(table(spark, sf_dir, "documents"))).withColumnRenamed("file_id", "doc_id")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096)


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), cycle=(5.0, 2.0, 1.0), share=1.5)


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare(table(spark, sf_dir, "documents"))


def prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic(table(spark, sf_dir, "documents"))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": languages,
    "op2_minhash": near_duplicates,
    "op3_sharding": shards,
    "op4_pii": personal_data,
    "op5_licenses": license_scan,
    "op6_packing": packed,
    "op7_mixing": mixture,
    "op8_chat": chats,
    "op9_topk": nearest_vectors,
    "op10_imatch": fingerprints,
    "op11_trie": prefixes,
    "op12_runs": word_runs,
    "op13_extraction": main_texts,
}

ORACLE_SQL = oracle.ORACLE_SQL
