"""Sharding: rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import common


def rendezvous(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of ``key``: the least ``-ln(u) / weight`` over the shards, u a hash of key and shard.

    A shard's expected part is its weight. A shard's score depends on nothing
    but the key and its own number and weight: one more shard takes records
    only into itself, a dropped one gives up only its own. Ties of equal
    scores go to the smaller shard. A null key hashes as one fixed key.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])

    def score(s: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, s["shard"]), 11)
        return F.struct((-F.log((bits + 0.5) / float(1 << 53)) / s["weight"]).alias("score"), s["shard"].alias("shard"))

    return F.array_min(F.transform(shards, score))["shard"].cast("int")


def assign(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 8,
    grown: Sequence[float] | None = None,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Shard, slot within the shard, and shard under the ``grown`` weights (one more equal shard by default).

    Returns key, size (UTF-8 bytes + 1), text_crc32, law, shard, slot,
    grown_shard. Null text has size 1 and the checksum of the empty text;
    rows with a null key share one key; repeated rows each get a slot of their
    own; an empty table gives no rows; other columns are left out, so their
    names cannot clash. Only the narrow row is stored and shuffled; a hot key
    is ranked task by task (``common.rank_within``).
    """
    grown = list(weights) + [weights[-1]] if grown is None else grown
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights, seed).alias("shard"),
        rendezvous(F.col(key), grown, seed).alias("grown_shard"),
    )
    ranked = common.rank_within(common.numbered(rows, "shards"), "shard", "slot")
    return ranked.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * 8, seed: int = 0, key: str = "doc_id") -> None:
    """Write whole records to ``path/shard=<n>/``; tasks write what they hold, so nothing is shuffled."""
    docs.withColumn("shard", rendezvous(F.col(key), weights, seed)).write.partitionBy("shard").parquet(path)
