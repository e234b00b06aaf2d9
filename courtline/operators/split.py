"""Season list, cutoff date, and the current / past split of game logs.

The cutoff is the first game date of the current (latest) season: one
partial aggregate per season (a handful of rows leave each task), then the
latest season's minimum. It is available as a value (``cutoff_value``, so the
split filters are pushed to the Parquet scan) or as a scalar-subquery column
(``cutoff``, a single plan). A game on the cutoff day is current and a null
date lands on neither side, as in the landing tasks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions import columns as fn


class EmptyCutoff(ValueError):
    """There is no game to take the cutoff from; nothing may be split or written."""


def first_game_dates(games: DataFrame, season_col: str = "SEASON", date_col: str = "GAME_DATE") -> DataFrame:
    """First game date of every season (one row per season)."""
    return (
        games.where(F.col(season_col).isNotNull())
        .groupBy(season_col)
        .agg(F.min(fn.to_date(date_col)).alias("FIRST_GAME_DATE"))
    )


def first_game_date(games: DataFrame, season_col: str = "SEASON", date_col: str = "GAME_DATE") -> DataFrame:
    """One row: the current season and its first game date."""
    return (
        first_game_dates(games, season_col, date_col)
        .orderBy(F.col(season_col).desc())
        .limit(1)
        .select(F.col(season_col).alias("CURRENT_SEASON"), "FIRST_GAME_DATE")
    )


def cutoff(games: DataFrame, season_col: str = "SEASON", date_col: str = "GAME_DATE") -> Column:
    """The cutoff date as a scalar-subquery column (evaluated once per query)."""
    return first_game_date(games, season_col, date_col).select("FIRST_GAME_DATE").scalar()


def cutoff_value(games: DataFrame, season_col: str = "SEASON", date_col: str = "GAME_DATE") -> _dt.date:
    """The cutoff date as a value (one small aggregate job).

    A literal cutoff lets the split filters reach the Parquet scan as pushed
    filters, which a scalar subquery does not. Raises ``EmptyCutoff`` where
    there is no such date.
    """
    row = first_game_date(games, season_col, date_col).first()
    if row is None or row["FIRST_GAME_DATE"] is None:
        raise EmptyCutoff("no dated game of a named season: the current season's first game date is unknown")
    return row["FIRST_GAME_DATE"]


def _bounds(games: DataFrame, cut, date_col: str):
    """(column, bound) to compare, on the raw column where that is exact.

    For a date-time column, ``cast(ts as date) >= d`` equals ``ts >= d 00:00``;
    comparing the raw column keeps the predicate pushable to Parquet.
    """
    if cut is None:
        raise EmptyCutoff("the cutoff is empty")
    if isinstance(cut, Column):
        return fn.to_date(date_col), cut
    if isinstance(cut, str):
        cut = _dt.date.fromisoformat(cut)
    if isinstance(cut, _dt.datetime):
        cut = cut.date()
    dtype = games.schema[date_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # A date cast to the column's type is midnight of that day, in the
        # session time zone for zoned timestamps, as ``cast(ts as date)`` is;
        # no Python-side time zone is involved.
        return F.col(date_col), F.lit(cut).cast(dtype)
    return fn.to_date(date_col), F.lit(cut)


def current_side(games: DataFrame, cut, date_col: str = "GAME_DATE") -> DataFrame:
    """Games on or after the cutoff."""
    c, b = _bounds(games, cut, date_col)
    return games.where(c >= b)


def past_side(games: DataFrame, cut, date_col: str = "GAME_DATE") -> DataFrame:
    """Games before the cutoff."""
    c, b = _bounds(games, cut, date_col)
    return games.where(c < b)


def seasons(team_year_totals: DataFrame, year_col: str = "YEAR") -> DataFrame:
    """Distinct seasons found in the yearly team totals, sorted ascending."""
    return (
        team_year_totals.where(F.col(year_col).isNotNull())
        .select(F.col(year_col).cast("string").alias("SEASON"))
        .distinct()
        .orderBy("SEASON")
    )
