"""Dashboard totals kept up to date by what changed between two versions of the fact table.

Every figure of ``reports.totals`` follows from sums: rows, wins, and for each
metric its sum and how many rows have it. Such sums are kept per group with
the version they are for. A refresh reads only the folders that came or went
since, the old rows counted down and the new ones up, and adds them to the
sums; rows that a rewrite left alone cancel out. A group without rows is
dropped.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import session
from courtline.functions import columns as fn
from courtline.operators.merge import FactTable
from courtline.operators.reports import SUM_METRICS
from courtline.sources import storage

SIGN = "_SIGN"
MEANS = {"PTS_PER_GAME": "PTS", "REB_PER_GAME": "REB", "AST_PER_GAME": "AST"}


def shares(facts: DataFrame, by) -> DataFrame:
    """What each row adds to the sums of its group; rows count as their ``_SIGN`` (1 or -1) where they have one."""
    sign = F.col(SIGN) if SIGN in facts.columns else F.lit(1)
    out = [sign.cast("bigint").alias("GAMES"), F.when(F.col("WL") == "W", sign).otherwise(F.lit(0)).cast("bigint").alias("WINS")]
    for m in SUM_METRICS:
        value = F.when(sign > 0, F.col(m)).otherwise(-F.col(m))
        out.append(F.coalesce(value, F.lit(0)).cast(_kind(facts, m)).alias(f"SUM_{m}"))
        out.append(F.when(F.col(m).isNotNull(), sign).otherwise(F.lit(0)).cast("bigint").alias(f"N_{m}"))
    return facts.select(*by, *out)


def additive(facts: DataFrame, by) -> DataFrame:
    """The sums of each group."""
    return _summed(shares(facts, by), by)


def _summed(shares: DataFrame, by) -> DataFrame:
    return shares.groupBy(*by).agg(*[F.sum(c).cast(shares.schema[c].dataType).alias(c) for c in shares.columns if c not in by])


def _kind(facts: DataFrame, metric: str) -> str:
    """The type of a metric's sum."""
    return facts.select(F.sum(metric).alias("s")).schema["s"].dataType.simpleString()


def added(sums: DataFrame, more: DataFrame, by) -> DataFrame:
    """The sums with ``more`` of them (sums or shares) put in, in one aggregate; groups that no row is left of are gone."""
    return _summed(sums.unionByName(more), list(by)).where(F.col("GAMES") > 0)


def finished(sums: DataFrame, by) -> DataFrame:
    """The figures of ``reports.totals`` from the sums: a metric that no row has is null."""
    metrics = [F.when(F.col(f"N_{m}") > 0, F.col(f"SUM_{m}")).alias(m) for m in SUM_METRICS]
    means = [fn.safe_ratio(f"SUM_{m}", f"N_{m}").alias(n) for n, m in MEANS.items()]
    out = sums.select(*by, "GAMES", "WINS", *metrics, *means)
    return out.select(
        "*",
        fn.safe_ratio("FGM", "FGA").alias("FG_PCT"),
        fn.safe_ratio("FG3M", "FG3A").alias("FG3_PCT"),
        fn.safe_ratio("FTM", "FTA").alias("FT_PCT"),
    )


@dataclass
class RefreshResult:
    version: int
    #: The version whose sums were brought up to date; None where all rows were read.
    since: int | None
    years_read: int


class TotalsTable:
    """Totals of a fact table by some of its columns, at ``path``.

    ``_states/<n>.json`` names the folder with the sums for version n of the
    fact table; the highest n counts. A refresh that fails leaves it.
    """

    def __init__(self, path: str, by):
        self.path = path.rstrip("/")
        self.by = list(by)
        self.states = f"{self.path}/_states"

    def version(self, spark: SparkSession) -> int | None:
        names = storage.list_names(spark, self.states)
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=None)

    def sums(self, spark: SparkSession) -> DataFrame:
        state = json.loads(storage.read_text(spark, f"{self.states}/{self.version(spark)}.json"))
        return spark.read.parquet(f"{self.path}/{state['folder']}")

    def read(self, spark: SparkSession) -> DataFrame:
        return finished(self.sums(spark), self.by)

    def refresh(self, spark: SparkSession, table: FactTable) -> RefreshResult:
        """Bring the totals to the table's latest version, from those of an earlier one where its manifest is still kept."""
        versions = table.versions(spark)
        if not versions:
            raise ValueError(f"{table.path} has no version to sum up")
        now, have = versions[-1], self.version(spark)
        if have == now:
            return RefreshResult(now, have, 0)
        since = have if have in versions else None
        if since is None:
            sums, years = additive(table.read(spark, now), self.by), len(table.manifest(spark, now))
        else:
            changes, changed = table.changes(spark, since, now)
            sums, years = added(self.sums(spark), shares(changes, self.by), self.by), len(changed)
        folder = f"sums/{now}-{uuid.uuid4().hex}"
        with session.for_writes(spark):
            sums.write.option("compression", session.codec(spark)).parquet(f"{self.path}/{folder}")
        # of two refreshes to one version, either's sums are right
        storage.write_text(spark, f"{self.states}/{now}.json", json.dumps({"folder": folder}))
        return RefreshResult(now, since, years)
