import collections
import zlib

from pyspark.sql import functions as F

from courtline.llm import sharding
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents


def test_shards_of_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = collected(sharding.assign(docs), "doc_id")
    assert len(rows) == len(texts)
    slots = collections.defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(rows) / 8 * 0.6 < len(s) < len(rows) / 8 * 1.4 for s in slots.values())
    assert 0.05 < sum(r["grown_shard"] == 8 for r in rows) / len(rows) < 0.18


def test_weights(spark):
    ids = spark.range(40_000).withColumn("shard", sharding.rendezvous(F.col("id"), [1, 2, 5]))
    n = {r["shard"]: r["count"] / 40_000 for r in ids.groupBy("shard").count().collect()}
    assert all(abs(n[i] - w / 8) < 0.02 for i, w in enumerate([1, 2, 5]))


def test_odd_rows_and_hot_key(spark):
    docs = odd_documents(spark, extra=[(77, "hot", "en", "a")] * 40).repartition(5)
    rows = sharding.assign(docs).collect()
    assert len(rows) == 53
    assert len({(r["shard"], r["slot"]) for r in rows}) == 53
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert sharding.assign(empty(spark)).count() == 0


def test_write(spark, tmp_dir):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    sharding.write(docs, tmp_dir + "/shards", (1.0,) * 4)
    back = spark.read.parquet(tmp_dir + "/shards")
    assert sorted(back.drop("shard").collect()) == sorted(docs.collect())


def test_every_shard_by_an_independent_rendezvous(spark):
    """Scores from xxh64 of the key's and shard's bytes, in plain Python, over the whole table and uneven weights."""
    import math
    import struct

    import xxhash

    def score(key, shard, weight, seed=0):
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        if key is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", key), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), h)
        return -math.log(((h >> 11) + 0.5) / 2**53) / weight

    def of(key, weights):
        return min((score(key, i, w), i) for i, w in enumerate(weights))[1]

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    for weights in ((1.0,) * 8, (3.0, 1.0, 0.5)):
        rows = sharding.assign(docs, weights).collect()
        assert all(r["shard"] == of(r["doc_id"], weights) for r in rows)
        assert all(r["grown_shard"] == of(r["doc_id"], [*weights, weights[-1]]) for r in rows)
    (none,) = sharding.assign(odd_documents(spark).filter("doc_id IS NULL")).select("shard").distinct().collect()
    assert none["shard"] == of(None, (1.0,) * 8)
