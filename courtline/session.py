"""Session helpers: builder defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that only apply when the deployment has not set the key already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(app: str = "courtline", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Get or create a session; library defaults fill only keys left unset.

    ``conf`` is applied as given. A default is set only when neither ``conf``
    nor the deployment (spark-defaults, submit options) names the key.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    deployed = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if k not in (conf or {}) and not deployed.contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system path, never a
    machine-local temporary folder. ``default`` is used (and set on the
    session) only when the session names none, as in tests; a local master,
    whose tasks all run in this process, then gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and default is None and re.match(r"local(\[|$)", spark.sparkContext.master):
        default = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not d:
        if default is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder of the cluster"
            )
        d = default
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def codec(spark: SparkSession) -> str:
    """Compression of the library's Parquet files: zstd, where neither deployment nor session names one."""
    return spark.conf.get("spark.sql.parquet.compression.codec", None) or "zstd"


#: Defaults of the library's own writes, for as long as these run.
_FOR_WRITES = {
    # Spark removes the shuffle files of each query when it ends. Else they stay on the executors' disks until the driver's
    # garbage collector finds their queries, so that a job of many writes keeps the shuffles of all.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM interprets methods of more bytes, and a projection or an aggregate of the fact table's columns in one method is larger.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def for_writes(spark: SparkSession):
    """Within the block the session has the defaults of ``_FOR_WRITES`` that neither deployment nor session has set.

    What is lazy must be written within it; a frame that is collected twice
    would run its stages again.
    """
    mine = [k for k in _FOR_WRITES if spark.conf.get(k, None) is None]
    for k in mine:
        spark.conf.set(k, _FOR_WRITES[k])
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: later steps read it without computing it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with for_writes(spark):
        df.write.option("compression", codec(spark)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/courtline-{name}-{uuid.uuid4().hex}"
