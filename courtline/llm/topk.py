"""Exact top-k by inner product over norm buckets.

Vectors are grouped by length (norm) into blocks. A query's k best scores
among the longest vectors bound its k-th best from below; divided by the
query's length and a block's greatest, this gives the local cosine threshold a
vector of the block must reach. Above 1 the block is skipped. A high threshold
prunes by coordinates (a vector near the query has coordinates near the
query's largest ones), a low one by length (the block is sorted, longest
first). What is left is verified by exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import common

#: Vectors in a block, queries in a block, seed vectors, ratio of norms in a bucket, and the threshold from which coordinates prune.
BLOCK, QUERIES, SEED, RATIO, COORDINATES_FROM = 4096, 1024, 4096, 1.1, 0.4
#: Blocks of queries and of vectors in one cell of the grid.
CELL = 8
#: Vectors this long or longer can have products beyond 64 bits.
LONGEST = 2.0**31
#: Parts in which block headers meet.
SALTS = 16
_SLACK = 1e-6  # of the bounds, far above rounding: candidates may be too many, never too few


def integers(vectors: DataFrame, scale: int = 64, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>, dim, norm) with ``floor(scale * x)``; vectors null or with null or non-finite components are left out.

    A vector of length ``LONGEST`` or more raises: its products could exceed 64 bits.
    """
    x = F.transform(F.col(column), lambda c: c.cast("double"))
    sound = F.col(column).isNotNull() & F.forall(F.col(column), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return (
        vectors.filter(sound & F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda c: F.try_multiply(c, F.lit(float(scale)))).alias("_x"))
        .withColumn("norm", F.sqrt(F.aggregate("_x", F.lit(0.0), lambda a, c: a + F.pow(F.abs(c) + 1, F.lit(2.0)))))
        .withColumn("_x", F.when(F.col("norm") < LONGEST, F.col("_x")).otherwise(F.raise_error(F.concat(F.lit("vector too long for 64-bit products: vec_id "), F.col("vec_id")))))
        .withColumn("v", F.transform("_x", lambda c: F.floor(c).cast("long")))
        .select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))).alias("norm"))
    )


def _bucket() -> F.Column:
    return F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(np.log(RATIO)))).otherwise(F.lit(-1)).cast("long")


_BLOCK = "dim int, bucket long, sub int, most double, ids binary, vectors binary"


def _packed(key: tuple, t: pa.Table) -> pa.Table:
    ids = np.array(t["vec_id"].to_numpy(), np.int64)
    v = np.array(t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(ids), -1)
    norm = t["norm"].to_numpy()
    order = np.lexsort((ids, -norm))
    return pa.table(
        {
            "dim": pa.array([key[0].as_py()], pa.int32()),
            "bucket": pa.array([key[1].as_py()], pa.int64()),
            "sub": pa.array([key[2].as_py()], pa.int32()),
            "most": pa.array([float(norm.max())], pa.float64()),
            "ids": pa.array([ids[order].tobytes()], pa.binary()),
            "vectors": pa.array([v[order].tobytes()], pa.binary()),
        }
    )


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of ``integers`` packed into about ``size`` each: dim, bucket (of norm), sub, greatest norm, ids, vectors (longest first).

    A bucket with many vectors, such as one common vector, is dealt out over
    as many blocks as its count asks for.
    """
    rows = rows.withColumn("bucket", _bucket())
    counts = rows.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_n"))
    # repeated ids are dealt apart as well: the hash takes in where the row is stored
    # one row for each dimension and bucket: all norms of a double are in fewer than 16,000 buckets
    dealt = rows.join(F.broadcast(counts), ["dim", "bucket"]).withColumn("sub", F.pmod(F.xxhash64("vec_id", "_row"), F.col("_n")).cast("int"))
    return dealt.select("dim", "bucket", "sub", "vec_id", "v", "norm").groupBy("dim", "bucket", "sub").applyInArrow(_packed, _BLOCK)


def _matrix(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.int64).reshape(len(i), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while that holds them exactly, else in 64-bit integers."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's k best in one block, those under its ``floor`` left out."""
    out: list[tuple[int, int, int]] = []
    xn = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    qn = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    most = xn[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(floor > 0, floor / (qn * most), -1.0)
    live = np.flatnonzero(~(local > 1 + _SLACK))
    plain = live[local[live] < COORDINATES_FROM]
    if len(plain):  # by length: the block is sorted, so a prefix of it is left
        scores = products(q[plain], x)
        for i, s in zip(plain.tolist(), scores, strict=True):
            n = len(ids) if floor[i] <= 0 else int(np.searchsorted(-xn, -(floor[i] / qn[i]) * (1 - _SLACK), side="right"))
            keep = np.flatnonzero((s[:n] >= floor[i]) & (ids[:n] != q_ids[i]))
            at = keep[best(ids[keep], s[keep], k)]
            out += zip([int(q_ids[i])] * len(at), ids[at].tolist(), s[at].tolist(), strict=True)
    near = live[local[live] >= COORDINATES_FROM]
    if len(near):
        unit = x / np.maximum(xn, 1e-300)[:, None]
        for i in near.tolist():
            n = int(np.searchsorted(-xn, -(floor[i] / qn[i]) * (1 - _SLACK), side="right"))
            u, t = q[i] / qn[i], min(1.0, local[i])
            keep = None
            # a unit vector within the angle of t has each coordinate within these bounds
            for f in np.argsort(-np.abs(u))[:3]:
                spread = np.sqrt(max(0.0, 1 - t * t) * max(0.0, 1 - u[f] * u[f])) + _SLACK
                lo, hi = u[f] * t - spread, u[f] * t + spread
                # towards the coordinate the bound widens to 1 where the query itself lies beyond t
                if abs(u[f]) >= t:
                    lo, hi = (lo, 1.0 + _SLACK) if u[f] > 0 else (-1.0 - _SLACK, hi)
                column = unit[:n, f] if keep is None else unit[keep, f]
                ok = np.flatnonzero((column >= lo) & (column <= hi))
                keep = ok if keep is None else keep[ok]
            s = products(x[keep], q[i : i + 1])[:, 0]
            ok = (s >= floor[i]) & (ids[keep] != q_ids[i])
            keep, s = keep[ok], s[ok]
            top = best(ids[keep], s, k)
            out += zip([int(q_ids[i])] * len(top), ids[keep[top]].tolist(), s[top].tolist(), strict=True)
    return out


_FOUND = "query_id long, vec_id long, score long"


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q_ids, q = _matrix(r["q_ids"], r["q"])
                ids, x = _matrix(r["ids"], r["vectors"])
                floor = np.frombuffer(r["floor"], np.int64) if r["floor"] else np.full(len(q_ids), np.iinfo(np.int64).min)
                found = search(q_ids, q, ids, x, k, floor)
                columns = list(zip(*found, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 20, scale: int = 64, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best, exactly.

    Queries are the vectors for which ``is_query`` holds (a condition on
    vec_id); candidates are all vectors but those with the query's own id.
    Ties go to the smaller vec_id; repeated rows of another id are candidates
    each. Vectors that are null, or hold null or non-finite components, and rows without vec_id take no
    part; a vector too long for 64-bit products raises; vectors of another dimension than the query's aren't its
    candidates; zero vectors score 0; an empty table gives no rows. Only
    vec_id and embedding are read.

    Blocks of queries meet blocks of vectors, never rows with rows, and only
    such blocks as a query's bound leaves. A block gives at most k rows for
    each query.
    """
    spark = vectors.sparkSession
    rows = common.numbered(integers(vectors, scale), "vectors")
    with common.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        index = common.stored(blocks(rows, block), "blocks")
        asked = common.stored(blocks(rows.filter(is_query), queries), "queries").select(
            "dim", F.col("bucket").alias("q_bucket"), F.col("sub").alias("q_sub"), F.col("most").alias("q_most"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q")
        )
    with common.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):  # rows are whole blocks now
        return common.stored(_found(asked, index, k), "nearest")


def _found(asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The k best of each query of the query blocks in the vector blocks."""
    asked = asked.repartition(max(1, asked.count()), "dim", "q_bucket", "q_sub")  # rows are large, the table isn't

    # the seed: each dimension's longest vectors, whole blocks until there are enough
    order = Window.partitionBy("dim").orderBy(F.desc("bucket"), "sub").rowsBetween(Window.unboundedPreceding, -1)
    listed = index.select("dim", "bucket", "sub", (F.length("ids") / 8).alias("n"))
    seed = common.stored(listed.withColumn("_before", F.coalesce(F.sum("n").over(order), F.lit(0))).filter(F.col("_before") < max(SEED, k + 1)).select("dim", "bucket", "sub"), "seed")

    def run(pairs: DataFrame, floor: F.Column) -> DataFrame:
        return pairs.select("q_ids", "q", "ids", "vectors", floor.alias("floor")).mapInArrow(_searched(k), _FOUND)

    # the seed has at most SEED vectors and one block more for each dimension
    longest = F.broadcast(index.join(seed, ["dim", "bucket", "sub"], "left_semi"))
    first = common.stored(run(asked.join(longest, "dim"), F.lit(None).cast("binary")), "first")
    # k-th best so far of each query; a query with fewer has no bound
    bound = _first(first, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    floors = common.stored(_with_floors(asked, bound), "floors")
    rest = index.join(seed, ["dim", "bucket", "sub"], "left_anti")
    left, right = cells(floors, rest)
    pairs = left.join(right, ["dim", "_down", "_across"]).filter(_may(F.col("least")))
    return _first(first.union(run(pairs, F.col("floor"))), k).select("query_id", "rank", "vec_id", "score")


def _may(least: F.Column) -> F.Column:
    """Whether the greatest product of two blocks' norms reaches the least bound of the queries."""
    return least <= F.col("q_most") * F.col("most") * (1 + _SLACK)


def cells(floors: DataFrame, rest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Query blocks and vector blocks, once for each cell of the grid that they are needed in (_down, _across).

    A cell has up to ``CELL`` query blocks and as many vector blocks of like
    norms, so that no task meets all queries or all vectors. First the headers
    alone meet (norms and bounds, no vectors): a block is sent to a cell only
    for some block of the cell that the bound leaves it.
    """
    heads = floors.select("dim", "q_bucket", "q_sub", "q_most", "least").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    heads = heads.withColumn("_down", F.xxhash64("q_bucket", F.floor(F.col("q_sub") / CELL)))
    others = rest.select("dim", "bucket", "sub", "most").withColumn("_salt", F.pmod(F.xxhash64("bucket", "sub"), F.lit(SALTS)).cast("int"))
    others = others.withColumn("_across", F.xxhash64("bucket", F.floor(F.col("sub") / CELL)))
    met = common.stored(heads.join(others, ["dim", "_salt"]).filter(_may(F.col("least"))).drop("_salt", "q_most", "most", "least"), "met")
    down = met.select("dim", "q_bucket", "q_sub", "_down", "_across").distinct()
    across = met.select("dim", "bucket", "sub", "_across", "_down").distinct()
    return floors.join(down, ["dim", "q_bucket", "q_sub"]), rest.join(across, ["dim", "bucket", "sub"])


def _with_floors(asked: DataFrame, bound: DataFrame) -> DataFrame:
    """Query blocks with each query's bound, as 64-bit integers in the block's order, and the least of them."""
    asked = asked.withColumn("_q", F.xxhash64("dim", "q_bucket", "q_sub"))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                i = np.frombuffer(r["q_ids"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), r["_q"])), pa.array(np.arange(len(i))), pa.array(i)], names=["_q", "_at", "query_id"]
                )

    least = F.lit(int(np.iinfo(np.int64).min))
    listed = asked.select("_q", "q_ids").mapInArrow(ids, "_q long, _at long, query_id long").join(bound, "query_id", "left")
    per = listed.groupBy("_q").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", F.coalesce("floor", least).alias("f")))), lambda s: s["f"]).alias("_f"),
        F.min(F.coalesce("floor", least)).alias("least"),
    )

    @F.arrow_udf("binary")
    def raw(v: pa.Array) -> pa.Array:
        return pa.array([np.array(x, np.int64).tobytes() for x in v.to_pylist()], pa.binary())

    return asked.join(per, "_q").withColumn("floor", raw("_f")).drop("_f", "_q")
