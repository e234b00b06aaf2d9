"""Shared helpers of the operators: reading, stored tables, distributed ranks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtline import session

#: Rows in one Arrow batch to Python: texts may be long, so batches are short.
ARROW_ROWS = 256


#: Parts of a value's rows in a sample.
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """``ARROW_ROWS`` rows in a batch where neither deployment nor session has set another number: the library's default.

    It bounds what the JVM holds of a batch; ``pieces`` bounds what a worker does.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key) and spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with ``values``, as it was before when the block ends: what is lazy must be stored within."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``rows`` rows: what a worker turns into Python objects at once, whatever the session's setting."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def give_back() -> None:
    """Return what a task has freed to the system: a worker outlives its tasks, and its memory counts as the executor's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed arrays otherwise
    if trim is not None:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage cut that survives lost executors."""
    return session.staged(df, name)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with ``_row``, a unique long whose upper bits are the writing task."""
    return stored(df.withColumn("_row", F.monotonically_increasing_id()), name)


def rank_within(df: DataFrame, key: str, out: str) -> DataFrame:
    """Gapless ranks from 0 within ``key`` (not null) for a ``numbered`` table.

    A key is ranked per writing task and the tasks' counts are summed before,
    so that a key with a third of all rows never meets in one task.
    """
    df = df.withColumn("_part", F.shiftright("_row", 33))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        df.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(key, "_part").orderBy("_row")) - 1
    return (
        df.withColumn("_local", local)
        .join(counts, [key, "_part"])
        .withColumn(out, (F.col("_before") + F.col("_local")).cast("long"))
        .drop("_part", "_local", "_before", "_row")
    )


def sample_ids(docs: DataFrame, n: int, by: str | None = None) -> DataFrame:
    """``doc_id`` of at most ``n`` rows (per value of ``by``), lowest key hashes first: a bounded, repeatable sample."""
    key = F.xxhash64(F.lit("sample"), "doc_id")
    if by is None:
        return docs.select("doc_id").distinct().orderBy(key, "doc_id").limit(n)
    out = docs.select(by, "doc_id", F.pmod(key, F.lit(SALTS)).alias("_salt")).distinct()
    # the lowest of each part of a value first, so that a value with a third of all rows isn't ordered in one task
    for group in ([by, "_salt"], [by]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(key, "doc_id"))
        out = out.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return out.select("doc_id")
