"""Named sources: a name -> (path, format, schema) registry returning DataFrames.

A staging table is a Parquet location exposed under a name, either as a
session view or as an external catalog table; reading through the registry
keeps every scan a plain file scan, so filters and column pruning reach it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from courtline import schemas

# Staging names of the pipeline and their raw contracts.
STAGING = {
    "player_games_current": schemas.RAW_GAME_LOG,
    "player_games_past": schemas.RAW_GAME_LOG,
    "players": schemas.RAW_PLAYERS,
    "teams": schemas.RAW_TEAMS,
    "team_games_past": None,
}


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    format: str = "parquet"
    schema: T.StructType | None = None


class Registry:
    """Resolve staging names to DataFrames."""

    def __init__(self, spark: SparkSession, sources: dict[str, Source] | None = None):
        self.spark = spark
        self.sources: dict[str, Source] = dict(sources or {})

    @classmethod
    def under(cls, spark: SparkSession, root: str, names=None, fmt: str = "parquet") -> "Registry":
        """One source per name at ``root/<name>`` with the staging contract."""
        root = root.rstrip("/")
        names = list(names or STAGING)
        return cls(spark, {n: Source(n, f"{root}/{n}", fmt, STAGING.get(n)) for n in names})

    def add(self, name: str, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> "Registry":
        self.sources[name] = Source(name, path, fmt, schema)
        return self

    def table(self, name: str, check: bool = False) -> DataFrame:
        """The source as a DataFrame.

        With ``check`` the columns are compared with the staging contract and
        a ``SchemaMismatch`` lists the missing ones (extra columns pass).
        """
        if name not in self.sources:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self.sources)}")
        s = self.sources[name]
        reader = self.spark.read.format(s.format)
        if s.schema is not None and s.format != "parquet":
            reader = reader.schema(s.schema)
        df = reader.load(s.path)
        if check and s.schema is not None:
            from courtline.operators.conform import require_columns

            require_columns(df, s.schema)
        return df

    def register_views(self, names=None, prefix: str = "") -> list[str]:
        """Expose sources as session views (the staging layer as views)."""
        done = []
        for n in names or self.sources:
            self.table(n).createOrReplaceTempView(prefix + n)
            done.append(prefix + n)
        return done

    def create_external_tables(self, database: str, names=None) -> list[str]:
        """Expose sources as external catalog tables over their locations."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        done = []
        for n in names or self.sources:
            s = self.sources[n]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{database}`.`{n}` USING {s.format} LOCATION '{s.path}'"
            )
            done.append(f"{database}.{n}")
        return done
