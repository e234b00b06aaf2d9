import math

import numpy as np
from pyspark.sql import functions as F

from courtline.llm import topk
from courtline.llm.common import table
from llm_util import collected


def brute(rows, every, k):
    vecs = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in vecs:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vecs if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(df, every=20, **options):
    rows = topk.top_k(df, F.col("vec_id") % every == 0, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


def test_embeddings(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    assert run(df) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 20, 20)


def test_pruned_blocks(spark, monkeypatch):
    """Norms over four orders, a hot vector, small blocks: all three ways of pruning."""
    rng = np.random.default_rng(1)
    v = rng.normal(0, 1, (700, 6)) * np.exp(rng.uniform(-4, 4, (700, 1)))
    v[::3] = v[0]
    v[1::50] = 0
    df = spark.createDataFrame([(i, x.tolist(), "c", 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, bucket string, dim int").repartition(5)
    monkeypatch.setattr(topk, "SEED", 40)
    monkeypatch.setattr(topk, "CELL", 2)
    got = run(df, 10, k=5, block=16, queries=8)
    assert got == brute([(i, x.tolist()) for i, x in enumerate(v)], 10, 5)


def test_search_prunes_nothing_it_needs():
    rng = np.random.default_rng(2)
    for n in range(60):
        x = rng.integers(-40, 40, (50, rng.integers(2, 6))) * rng.integers(1, 4, (50, 1))
        x = x[np.argsort(-np.sqrt((x**2).sum(1)), kind="stable")]
        q = rng.integers(-40, 40, (9, x.shape[1]))
        ids, q_ids = np.arange(50), np.arange(100, 109)
        s = q @ x.T
        floor = np.sort(s, 1)[:, -3] if n % 2 else rng.integers(-3000, 6000, 9)
        got = topk.search(q_ids, q, ids, x, 3, floor)
        want = []
        for i in range(9):
            order = sorted((-s[i, j], j) for j in range(50) if s[i, j] >= floor[i])[:3]
            want += [(100 + i, j, -t) for t, j in order]
        assert sorted(got) == sorted(want)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]), (20, [0.0, 0.0]), (None, [9.0, 9.0]), (7, []), (40, [-1.0, -0.001]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, k=3) == brute(rows, 20, 3)
    assert run(df.filter("false")) == []


def test_products_are_exact():
    a = np.array([[3_000_000_019, 1]], np.int64)
    assert topk.products(a, np.array([[1_000_000_007, 1]], np.int64))[0, 0] == 3_000_000_019 * 1_000_000_007 + 1


def test_vectors_beyond_64_bits_raise(spark):
    import pytest

    for x in (3e17, 1e300, 2.0**26):
        df = spark.createDataFrame([(0, [x, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="64-bit"):
            run(df)
    rows = [(0, [2.0**24, -(2.0**24)]), (1, [2.0**24, 1.0]), (2, [-(2.0**24), 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df) == brute(rows, 20, 20)


def test_session_is_left_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    run(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"))
    assert spark.conf.get(key) == before


def test_blocks_go_only_where_a_bound_leaves_them(spark):
    """Headers meet first: a block that every query's bound rules out is sent nowhere, another to its cells alone."""
    floors = spark.createDataFrame([(2, b, 0, 10.0, least) for b, least in ((1, 50), (2, 200), (3, 10**9))], "dim int, q_bucket long, q_sub int, q_most double, least long")
    rest = spark.createDataFrame([(2, b, s, most) for b, s, most in ((1, 0, 1.0), (2, 0, 6.0), (3, 0, 30.0), (3, 9, 30.0))], "dim int, bucket long, sub int, most double")
    left, right = topk.cells(floors, rest)
    assert sorted((r["q_bucket"]) for r in left.collect()) == [1, 1, 1, 2, 2]  # cells of (2, 0), (3, 0) and (3, 9); of (3, 0) and (3, 9)
    assert sorted((r["bucket"], r["sub"]) for r in right.collect()) == [(2, 0), (3, 0), (3, 0), (3, 9), (3, 9)]
