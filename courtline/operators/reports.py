"""Load reports and dashboard tables over the typed fact table.

Scale notes. Every report aggregates first (partial aggregation inside each
map task, so a player or team holding a large share of the rows is reduced
before the shuffle), and windows only run over the aggregated rows:
* ranks come from the histogram of values per (season, game type), cut into
  ranges of values, so a window runs over one range's distinct values;
* the season trend is partitioned by entity over per-season totals;
* top-k per group uses ``row_number() <= k``, which Spark plans as a
  ``WindowGroupLimit`` that keeps k rows per group inside each task first;
* the running row count orders the per-season counts (a few dozen rows)
  globally; it never orders game rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.functions import columns as fn

# Summed metrics of the dashboard totals.
SUM_METRICS = (
    "MIN", "PTS", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB",
    "REB", "AST", "STL", "BLK", "TOV", "PF",
)


# ---------------------------------------------------------- load reports ---


def rows_per_season(games: DataFrame, season_col: str = "SEASON") -> DataFrame:
    """Row count per season of a load."""
    return games.groupBy(season_col).agg(F.count(F.lit(1)).alias("N_ROWS"))


def running_rows(games: DataFrame, season_col: str = "SEASON") -> DataFrame:
    """Rows per season and the running total up to each season.

    The global window runs over the per-season counts only.
    """
    w = Window.orderBy(season_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows_per_season(games, season_col).withColumn(
        "TOTAL_ROWS", F.sum("N_ROWS").over(w).cast("bigint")
    )


def skipped_seasons(requested: DataFrame, found: DataFrame, col: str = "SEASON") -> DataFrame:
    """Requested seasons for which no extract was found (coverage report)."""
    return requested.select(col).distinct().join(found.select(col).distinct(), col, "left_anti")


def latest_game(games: DataFrame, date_col: str = "GAME_DATE", tie=("GAME_ID", "PLAYER_ID", "TEAM_ID")) -> DataFrame:
    """The most recent game row; ties broken by the key for a stable answer.

    Two pruned steps: the greatest date from that one column, then the rows of
    that date (a filter that reaches the scan), of which the first is taken.
    Without any date the first row by key is.
    """
    last = games.agg(F.max(date_col).alias("d")).first()["d"]  # one value
    if last is not None:
        games = games.where(F.col(date_col) == F.lit(last).cast(games.schema[date_col].dataType))
    return games.orderBy(*tie).limit(1)


# -------------------------------------------------------- dashboard joins ---


def with_names(facts: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Fact rows with player and team names (left joins on the dimension ids).

    Left to the planner's and AQE's byte thresholds: a dimension below them is
    broadcast and the fact rows are joined where they are read.
    """
    p = players.select(F.col("ID").alias("PLAYER_ID"), F.col("FULL_NAME").alias("PLAYER_NAME"))
    t = teams.select(
        F.col("ID").alias("TEAM_ID"),
        F.col("FULL_NAME").alias("TEAM_NAME"),
        F.col("ABBREVIATION").alias("TEAM_ABBREVIATION"),
    )
    return facts.join(p, "PLAYER_ID", "left").join(t, "TEAM_ID", "left")


def totals(facts: DataFrame, by) -> DataFrame:
    """Totals and per-game figures of each metric by the given keys.

    Shooting percentages are sum(made) / sum(attempted).
    """
    aggs = [
        F.count(F.lit(1)).alias("GAMES"),
        F.count(F.when(F.col("WL") == "W", F.lit(1))).alias("WINS"),
    ]
    aggs += [F.sum(m).alias(m) for m in SUM_METRICS]
    aggs += [F.avg("PTS").alias("PTS_PER_GAME"), F.avg("REB").alias("REB_PER_GAME"), F.avg("AST").alias("AST_PER_GAME")]
    out = facts.groupBy(*by).agg(*aggs)
    return out.select(
        "*",
        fn.safe_ratio("FGM", "FGA").alias("FG_PCT"),
        fn.safe_ratio("FG3M", "FG3A").alias("FG3_PCT"),
        fn.safe_ratio("FTM", "FTA").alias("FT_PCT"),
    )


def compare(facts: DataFrame, entity: str, named, metric: str = "PTS", by: str = "SEASON_YEAR", prefix: str | None = None) -> DataFrame:
    """One column per named entity with its summed metric, one row per ``by``."""
    named = list(named)
    prefix = prefix or entity.split("_")[0]
    out = facts.where(F.col(entity).isin(named)).groupBy(by).pivot(entity, named).agg(F.sum(metric))
    return out.select(by, *[F.col(f"`{v}`").alias(f"{prefix}_{v}_{metric}") for v in named])


def dealt_by_value(hist: DataFrame, partition, metric: str, ranges: int = 64) -> DataFrame:
    """``hist`` (one row for each partition and value) with ``_range``: ranges of about as many distinct values each.

    The bounds are quantiles of a partition's distinct values (partial
    sketches, ``ranges`` - 1 values for a partition), greatest values first;
    equal values are in one range, nulls in the last one.
    """
    part = list(partition)
    at = F.array(*[F.lit((i + 1) / ranges) for i in range(ranges - 1)])
    bounds = hist.groupBy(*part).agg(F.percentile_approx(metric, at, F.lit(100 * ranges)).alias("_cuts"))
    bounds = bounds.select(*[F.col(c).alias(f"_p_{c}") for c in part], "_cuts")
    above = F.size(F.filter("_cuts", lambda c: c > F.col(metric)))
    dealt = hist.join(bounds, _same(hist, bounds, part, "_p_"), "left")
    return dealt.withColumn("_range", F.when(F.col(metric).isNull(), F.lit(ranges)).otherwise(F.coalesce(above, F.lit(0)))).select(*hist.columns, "_range")


def _same(left: DataFrame, right: DataFrame, columns, prefix: str):
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[f"{prefix}{c}"])
    return cond


def rank_within(df: DataFrame, partition, metric: str, ranges: int = 64) -> DataFrame:
    """rank and dense_rank of ``metric`` (descending, nulls last) in each partition.

    The rows are aggregated once to a histogram that keeps each value's rows,
    and the histogram is dealt into ``ranges`` ranges of values of equal depth
    within each partition (``dealt_by_value``). Windows run inside a range, and
    ranges' totals are summed before, so neither a season with a third of all
    rows nor one with as many distinct values as rows is sorted in one task,
    however its values are spread.
    """
    part = list(partition)
    value = F.col(metric)
    hist = df.groupBy(*part, metric).agg(F.count(F.lit(1)).alias("_n"))
    dealt = dealt_by_value(hist, part, metric, ranges)
    per = dealt.groupBy(*part, "_range").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    before = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        *[F.col(c).alias(f"_p_{c}") for c in part],
        F.col("_range").alias("_p__range"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_values_before"),
    )
    inside = Window.partitionBy(*part, "_range").orderBy(value.desc_nulls_last())
    above = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = dealt.select("*", above.alias("_above"), F.row_number().over(inside).alias("_place"))
    ranks = ranked.join(per, _same(ranked, per, [*part, "_range"], "_p_")).select(
        *[F.col(c).alias(f"_r_{c}") for c in [*part, metric]],
        (F.col("_rows_before") + F.col("_above") + 1).cast("bigint").alias(f"{metric}_RANK"),
        (F.col("_values_before") + F.col("_place")).cast("bigint").alias(f"{metric}_DENSE_RANK"),
    )
    return df.join(ranks, _same(df, ranks, [*part, metric], "_r_"), "inner").select(*df.columns, f"{metric}_RANK", f"{metric}_DENSE_RANK")


def trend(facts: DataFrame, entity: str, metric: str = "PTS", season_col: str = "SEASON_YEAR", games: Column | None = None) -> DataFrame:
    """Per entity and season: the metric, its previous-season value and change.

    ``games`` counts a group's games where a row of ``facts`` is not one game.
    """
    games = F.count(F.lit(1)) if games is None else games
    per = facts.groupBy(entity, season_col).agg(games.alias("GAMES"), F.sum(metric).alias(metric))
    w = Window.partitionBy(entity).orderBy(season_col)
    prev = F.lag(metric).over(w)
    return per.select("*", prev.alias(f"PREV_{metric}"), (F.col(metric) - prev).alias(f"{metric}_CHANGE"))


def top_k(df: DataFrame, metric: str, k: int, tie) -> DataFrame:
    """The k rows with the largest metric (a top-k sort, not a full sort)."""
    tie = [tie] if isinstance(tie, str) else list(tie)
    return df.orderBy(F.col(metric).desc(), *tie).limit(k)


def top_k_per_group(df: DataFrame, group, metric: str, k: int, tie) -> DataFrame:
    """The k rows with the largest metric in each group, numbered 1..k."""
    tie = [tie] if isinstance(tie, str) else list(tie)
    w = Window.partitionBy(*group).orderBy(F.col(metric).desc(), *tie)
    return df.withColumn("POS", F.row_number().over(w).cast("bigint")).where(F.col("POS") <= k)
