"""Test tables shaped as the pipeline's inputs (tests and driver checks only).

The driver's tables are a star schema of orders and line items. A line item
stands for one player's line in one game: part -> player, supplier -> team,
order -> game. Each proxy column is one SQL expression that Spark SQL and
DuckDB evaluate alike, so the oracle queries start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import session

# The proxy mapping of a raw player game log.
# Stats are cast to double, as extracts carry them (NaN for missing).
GAME_LOG_EXPR = {
    "PLAYER_ID": "l_partkey",
    "TEAM_ID": "l_suppkey",
    "GAME_ID": "lpad(cast(l_orderkey as string), 10, '0')",
    "GAME_DATE": "o_orderdate",
    "WL": "case when l_returnflag = 'R' then 'W' else 'L' end",
    "MIN": "cast(l_quantity as double)",
    "FGM": "cast(l_linenumber as double)",
    "FGA": "cast(l_quantity as double)",
    "FG_PCT": "cast(l_discount as double)",
    "FG3M": "cast(l_linenumber - 1 as double)",
    "FG3A": "cast(l_quantity / 4 as double)",
    "FG3_PCT": "cast(l_tax as double)",
    "FTM": "cast(l_linenumber - 1 as double)",
    "FTA": "cast(l_linenumber as double)",
    "FT_PCT": "cast(1 - l_discount as double)",
    "OREB": "cast(l_linenumber as double)",
    "DREB": "cast(l_quantity / 10 as double)",
    "REB": "cast(l_linenumber + l_quantity / 10 as double)",
    "AST": "cast(l_tax * 100 as double)",
    "TOV": "cast(l_discount * 100 as double)",
    "STL": "cast(l_linenumber % 3 as double)",
    "BLK": "cast(l_linenumber % 2 as double)",
    "BLKA": "cast(l_linenumber % 4 as double)",
    "PF": "cast(l_linenumber as double)",
    "PFD": "cast(l_linenumber + 1 as double)",
    "PTS": "cast(l_quantity as double)",
    "PLUS_MINUS": "cast((l_quantity - 25) / 2 as double)",
    "GAME_TYPE": "case when o_orderpriority = '1-URGENT' then 'Playoffs' else 'Regular Season' end",
    "SEASON": "cast(year(o_orderdate) as string)",
}
GAME_LOG_FROM = "lineitem join orders on l_orderkey = o_orderkey"

# The proxy mapping of the landed player list.
PLAYERS_EXPR = {
    "id": "p_partkey",
    "full_name": "p_name",
    "first_name": "split_part(p_name, ' ', 1)",
    "last_name": "split_part(p_name, ' ', -1)",
    "is_active": "p_size >= 25",
}
PLAYERS_FROM = "part"

# The proxy mapping of the landed team list.
TEAMS_EXPR = {
    "id": "s_suppkey",
    "full_name": "s_name",
    "abbreviation": "right(s_name, 3)",
    "nickname": "concat('Team ', right(s_name, 3))",
    "city": "n_name",
    "state": "r_name",
    "year_founded": "cast(1946 + s_nationkey as bigint)",
}
TEAMS_FROM = (
    "supplier left join nation on s_nationkey = n_nationkey "
    "left join region on n_regionkey = r_regionkey"
)

# Per-team yearly totals list the seasons a team played.
TEAM_YEARS_EXPR = {"TEAM_ID": "TEAM_ID", "YEAR": "SEASON"}

# The requested season range of the coverage report.
REQUESTED_SEASONS = (1990, 2005)

# Named teams of the comparison report.
COMPARED_TEAMS = (1, 2, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in exprs.items()])


def game_logs(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Raw game logs: line items joined to their orders.

    ``stored`` joins them once, for queries that read the logs several times:
    the two tables' columns that the logs are made of, under the shared folder.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    if stored:
        used = [c for c in joined.columns if any(re.search(rf"\b{c}\b", e) for e in GAME_LOG_EXPR.values())]
        joined = session.staged(joined.select(*used), "games")
    return _select(joined, GAME_LOG_EXPR)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "part"), PLAYERS_EXPR)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(
        r, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return _select(j, TEAMS_EXPR)


def team_year_totals(games: DataFrame) -> DataFrame:
    """One row per team and season played (the yearly totals' YEAR list)."""
    return _select(games, TEAM_YEARS_EXPR).distinct()


def requested_seasons(spark: SparkSession, first: int = REQUESTED_SEASONS[0], last: int = REQUESTED_SEASONS[1]) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("string").alias("SEASON"))


# SQL text of the same inputs, for the DuckDB oracle.


def _sql_select(exprs: dict, src: str) -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in exprs.items()) + f" from {src}"


GAME_LOG_SQL = _sql_select(GAME_LOG_EXPR, GAME_LOG_FROM)
PLAYERS_SQL = _sql_select(PLAYERS_EXPR, PLAYERS_FROM)
TEAMS_SQL = _sql_select(TEAMS_EXPR, TEAMS_FROM)
