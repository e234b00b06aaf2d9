"""Mixing sources to target weights: exact block quotas, split among shards by a hypergeometric tree.

Each source's documents fall into permuted blocks by a hash of their key. The
mix takes whole passes over a source and then, of one more pass, the first
blocks in permuted order up to the target; of the block that the target cuts,
parts by a finer hash as far as they fit. A tree over the output shards splits the taken blocks: at each node a
multivariate hypergeometric draw says how many blocks of each source go left,
so that shards have equal numbers of blocks and random, disjoint contents.
Within a shard, rows are ordered by a hash of key and pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import common

#: Blocks of a source, and parts of the block that the target cuts.
BLOCKS, PARTS = 1 << 12, 1 << 14
CYCLE = (5.0, 2.0, 1.0)


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off is shared out again by weight."""
    out = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def split_tree(blocks: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) in each shard (columns), by recursive hypergeometric splits into halves."""
    out = np.zeros((len(blocks), shards), np.int64)

    def split(counts: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = counts
            return
        mid, total = (lo + hi) // 2, int(counts.sum())
        # a path of its own for every node, so that a node's draw depends on the seed and the node alone
        rng = np.random.default_rng([seed, lo, hi])
        left_n = total * (mid - lo) // (hi - lo)
        left = np.zeros_like(counts)
        rest_n, rest = left_n, total
        for i, n in enumerate(counts.tolist()):  # one source after another: the marginal draws of the joint law
            rest -= n
            left[i] = rng.hypergeometric(n, rest, rest_n) if n and rest_n else 0
            rest_n -= int(left[i])
        split(left, lo, mid)
        split(counts - left, mid, hi)

    if len(blocks):
        split(np.array(blocks, np.int64), 0, shards)
    return out


def mix(
    docs: DataFrame,
    size: Column | None = None,
    cycle: Sequence[float] = CYCLE,
    share: float = 1.5,
    shards: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Every row of ``docs`` with its size, source_size, target and its draws.

    Adds ``size`` (words by default), ``source_size``, ``target`` and
    ``draws``, an array of (shard, position) with one entry for each time the
    mix takes the row: none, one or two. Sources take the weights of ``cycle``
    in code point order, null last (null is a source of its own; empty names
    come first). Null and empty texts have size 0 and are drawn like others; a
    source of no words has target 0 and draws none. Rows are told apart by
    doc_id and text: those that repeat both are drawn alike, others not,
    whatever their ids. An empty table gives no rows. Columns named like the
    added ones are replaced.

    What reaches the driver is one row for each source: the mix has a weight
    for each. The sums of its blocks and parts stay in tables.
    """
    unit = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    base = docs.withColumns({"size": words(F.col("text")) if size is None else size, "_u": unit})
    base = base.withColumns({"_block": F.pmod("_u", F.lit(BLOCKS)).cast("int"), "_part": F.pmod(F.shiftright("_u", 12), F.lit(PARTS)).cast("int")})
    narrow = common.stored(base.select("source", "size", "_block", "_part"), "sizes")
    spark = docs.sparkSession
    total = {r["source"]: r["n"] for r in narrow.groupBy("source").agg(F.sum("size").alias("n")).collect()}  # one row for each source
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode("utf-8", "surrogatepass")) + [None] * (None in total)
    sizes = [int(total[s]) for s in names]
    target = targets(sizes, [cycle[i % len(cycle)] for i in range(len(names))], share * sum(sizes))
    passes = [int(t // s) if s else 0 for s, t in zip(sizes, target, strict=True)]
    rows = [(n, i, s, float(t), p, float(t - p * s)) for i, (n, s, t, p) in enumerate(zip(names, sizes, target, passes, strict=True))]
    sources = spark.createDataFrame(rows, "_s string, _i int, source_size long, target double, _passes int, _rest double")
    sources = common.stored(sources, "sources")

    def of_source(df: DataFrame) -> DataFrame:
        return df.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    # a source's blocks in a keyed order, the same in each pass: which of them the last pass takes whole, and which it cuts
    order = Window.partitionBy("_i").orderBy(F.xxhash64(F.lit(seed), F.lit("order"), "_i", "_block"), "_block")
    blocks = of_source(narrow.groupBy("source", "_block").agg(F.sum("size").alias("n"))).withColumn("_place", F.row_number().over(order) - 1)
    blocks = blocks.withColumn("_upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = blocks.select("_i", "_block", "_place", ((F.col("_upto") <= F.col("_rest")) & (F.col("_rest") > 0)).alias("_whole"), (F.col("_rest") - F.col("_upto") + F.col("n")).alias("_need"))
    blocks = common.stored(blocks, "blocks")
    cut = blocks.filter("NOT _whole AND _need > 0").groupBy("_i").agg(F.min(F.struct("_place", "_block", "_need")).alias("_cut"))
    cut = cut.select("_i", "_cut._block", "_cut._need")
    held = of_source(narrow).join(cut, ["_i", "_block"]).groupBy("_i", "_block", "_part", "_need").agg(F.sum("size").alias("n"))
    fits = common.stored(held.groupBy("_i").applyInPandas(_fitting, "_i int, _block int, _part int, _fits boolean"), "parts")

    # draws of a source: its blocks, pass by pass in that order; a shard takes a range of them
    counts = {r["_i"]: r for r in blocks.groupBy("_i").agg(F.count(F.lit(1)).alias("all"), F.count_if("_whole").alias("whole")).collect()}
    some = {r["_i"] for r in fits.filter("_fits").select("_i").distinct().collect()}
    drawn = [p * counts[i]["all"] + counts[i]["whole"] + (i in some) if s else 0 for i, (p, s) in enumerate(zip(passes, sizes, strict=True))]
    ends = np.cumsum(split_tree(drawn, shards, seed), axis=1)
    number = [(i, counts[i]["all"], ends[i].tolist()) for i in range(len(names))]
    numbers = common.stored(spark.createDataFrame(number, "_i int, _all long, _ends array<long>"), "ends")
    of_source_too = sources.join(numbers, "_i")
    joined = base.join(_small(of_source_too, len(names)), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    joined = joined.join(_small(blocks.drop("_need"), sum(r["all"] for r in counts.values())), ["_i", "_block"], "left")
    joined = joined.join(_small(fits, fits.count()), ["_i", "_block", "_part"], "left")
    last = F.col("_whole") | F.coalesce("_fits", F.lit(False))
    times = F.when(F.col("source_size") > 0, F.col("_passes") + last.cast("int")).otherwise(0)

    def draw(k: Column) -> Column:
        at = k * F.col("_all") + F.col("_place")
        return F.struct(
            F.size(F.filter(F.col("_ends"), lambda e: e <= at)).alias("shard"),
            F.xxhash64(F.lit(seed), F.lit("position"), F.col("_u"), k).alias("position"),
        )

    draws = F.when(times > 0, F.transform(F.sequence(F.lit(0), times - 1), draw)).otherwise(
        F.array().cast("array<struct<shard:int,position:bigint>>")
    )
    out = joined.withColumn("draws", draws)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "draws")]
    return out.select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", "draws")


def _fitting(parts):
    """Which parts of one source's cut block are taken: one after another, as long as they fit, and the last that comes nearer so."""
    parts = parts.sort_values("_part")
    need, fits = float(parts["_need"].iloc[0]) if len(parts) else 0.0, []
    for n in parts["n"].tolist():
        take = n <= need
        fits.append(take)
        need -= n if take else 0
    # of those that didn't fit, the smallest one if it is nearer to the target with it
    left = [(n, j) for j, (n, took) in enumerate(zip(parts["n"].tolist(), fits, strict=True)) if not took]
    if left and min(left)[0] < 2 * need:
        fits[min(left)[1]] = True
    return parts[["_i", "_block", "_part"]].assign(_fits=fits)


#: Rows of a plan that are sent to every task; a longer one (of hundreds of sources) is joined by its keys.
BROADCAST_ROWS = 1 << 20


def _small(plan: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(plan) if rows <= BROADCAST_ROWS else plan


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the row, repeats counted), and each draw's shard and position."""
    return mix(docs.select("doc_id", "text", "source"), **options).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("draws")).cast("long").alias("taken"),
        F.col("draws.shard").alias("shards"),
        F.col("draws.position").alias("positions"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is drawn, columns unchanged."""
    out = mix(docs, **options)
    return out.withColumn("_draw", F.explode("draws")).select(*[F.col(f"`{c}`") for c in docs.columns])


def write(docs: DataFrame, path: str, shards: int = 8, **options) -> None:
    """Write the mix to ``path/shard=<n>/``, each file in the order of the draws' positions."""
    out = mix(docs, shards=shards, **options).withColumn("_draw", F.explode("draws"))
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_draw.shard").alias("shard"), F.col("_draw.position").alias("_position"))
    spread = out.repartition("shard", F.pmod(F.col("_position"), F.lit(64)))
    spread.sortWithinPartitions("shard", "_position").drop("_position").write.partitionBy("shard").parquet(path)
