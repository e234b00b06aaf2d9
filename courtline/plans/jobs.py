"""The pipeline's jobs as plain functions (no scheduler; call them in order).

K1 refresh_players     landed player list -> typed dimension, full refresh
K2 refresh_teams       landed team list -> typed dimension, full refresh
K3 land_past           per-season extracts -> past games before the cutoff
K4 land_current        current-season extracts -> games from the cutoff on
K5 refresh_facts       landed current + past -> keyed merge into the fact table
K6 land_team_past      team game logs -> past team games, coverage report
K7 (K3/K4 with game_types=None: extracts laid out by season only)
K8 union_report        past and current by name -> latest game through SQL
K9 (coverage: requested seasons without an extract, returned by K3/K6)
K10 dashboard          fact table + dimensions -> report tables

All feeds are split at one date, the first game of the current season
(``current_cutoff``), so that each dated game lands on exactly one side.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import schemas, session
from courtline.operators import combine, conform, merge, reports, split
from courtline.sources import footers, landed, ledger, sinks

# The game types that extracts are landed for.
GAME_TYPES = ("Regular Season", "Playoffs")


@dataclass
class LandingResult:
    """What a landing wrote, and what it did not.

    ``no_season`` counts the rows read without a season, which no season's
    report counts; ``skipped`` has the listed seasons without an extract,
    ``unlisted`` the seasons with an extract that are not listed (not landed);
    ``failed`` the files that could not be read (SEASON, FILE, ERROR), whose
    folders were left out.
    """

    path: str
    rows: DataFrame
    skipped: DataFrame | None = None
    no_season: int = 0
    unlisted: DataFrame | None = None
    failed: DataFrame | None = None


# --------------------------------------------------------- dimensions ---


def refresh_players(spark: SparkSession, src, out_path: str, fmt: str = "parquet") -> DataFrame:
    raw = src if isinstance(src, DataFrame) else landed.read_list(spark, src, fmt)
    sinks.write_table(conform.conform_players(raw), out_path)
    return spark.read.parquet(out_path)


def refresh_teams(spark: SparkSession, src, out_path: str, fmt: str = "parquet") -> DataFrame:
    raw = src if isinstance(src, DataFrame) else landed.read_list(spark, src, fmt)
    sinks.write_table(conform.conform_teams(raw), out_path)
    return spark.read.parquet(out_path)


# ------------------------------------------------------------ landing ---


def _prepare(df: DataFrame) -> DataFrame:
    """Landing shape: FTA, REB, AST, PF filled and integral; dates parsed."""
    return conform.parse_dates(conform.fill_stats(df))


def _read(spark: SparkSession, root: str, game_types, seasons=None, failed: list | None = None) -> DataFrame:
    return landed.read_game_logs(
        spark, root, seasons=seasons, game_types=game_types, with_game_type=game_types is not None, failed=failed
    )


def _failures(spark: SparkSession, failed: list) -> DataFrame:
    """One row for each unreadable file."""
    return spark.createDataFrame([(values[0], file, error) for values, file, error in failed], "SEASON string, FILE string, ERROR string")


def _coverage(spark: SparkSession, extracts_root: str, team_totals_root: str | None):
    """(listed seasons, those without an extract, extracts' seasons that are not listed); nulls without yearly totals."""
    if team_totals_root is None:
        return None, None, None
    wanted = split.seasons(landed.read_team_year_totals(spark, team_totals_root))
    have = spark.createDataFrame([(s,) for s in landed.list_seasons(spark, extracts_root)], "SEASON string")
    listed = [r["SEASON"] for r in wanted.collect()]  # one row for each season ever played
    return listed, reports.skipped_seasons(wanted, have), reports.skipped_seasons(have, wanted)


def _rows_without_season(df: DataFrame) -> int:
    return df.where(F.col("SEASON").isNull()).count()


def current_cutoff(spark: SparkSession, current_extracts: str, season: str | None = None, game_types=GAME_TYPES) -> dt.date:
    """First game date of the current season, by which every feed is split.

    The season is the latest ``SEASON=`` folder of the current extracts
    unless given. Its least date is taken from the footers of that season's
    files, which reads no data; where they don't tell it, from that one column.
    Raises ``EmptyCutoff`` where there is none.
    """
    if season is None:
        found = landed.list_seasons(spark, current_extracts)
        if not found:
            raise split.EmptyCutoff(f"no season under {current_extracts}")
        season = found[-1]
    tags = ("SEASON",) if game_types is None else ("SEASON", "GAME_TYPE")
    files = footers.season_files(spark, current_extracts, season, tags, None if game_types is None else lambda v: v[1] in game_types)
    try:
        least = footers.least_date(spark, files, "GAME_DATE")
    except footers.NoStatistics:
        return split.cutoff_value(_read(spark, current_extracts, game_types, [season]).select("SEASON", "GAME_DATE"))
    if least is None:
        raise split.EmptyCutoff(f"no dated game of {season} under {current_extracts}")
    return least


def land_past(
    spark: SparkSession,
    extracts_root: str,
    out_path: str,
    cutoff: dt.date | str,
    team_totals_root: str | None = None,
    game_types=GAME_TYPES,
    on_unreadable: str = "skip",
) -> LandingResult:
    """Past games: every listed season's extracts, before ``cutoff``.

    ``cutoff`` is that of the current season (``current_cutoff``), whatever
    this root holds. Seasons are listed from the yearly team totals when given
    (distinct, sorted); a listed season with no extract is reported, not
    fatal. Dated rows without a season are landed and counted.

    All footers are read before anything is written. A folder with a file that
    cannot be read is left out and reported, and the other seasons land
    (``on_unreadable="error"`` raises instead).
    """
    listed, skipped, unlisted = _coverage(spark, extracts_root, team_totals_root)
    failed: list = []
    logs = _read(spark, extracts_root, game_types, failed=failed if on_unreadable == "skip" else None)
    if listed is not None:
        logs = logs.where(F.col("SEASON").isin(listed) | F.col("SEASON").isNull())
    past = split.past_side(_prepare(logs), cutoff)
    sinks.write_landed(past, out_path)
    written = spark.read.parquet(out_path)
    return LandingResult(
        out_path, reports.running_rows(written), skipped, _rows_without_season(written), unlisted, _failures(spark, failed)
    )


def land_past_changes(
    spark: SparkSession,
    extracts_root: str,
    out_path: str,
    cutoff: dt.date | str,
    team_totals_root: str | None = None,
    game_types=GAME_TYPES,
) -> tuple[DataFrame, ledger.LedgerResult]:
    """``land_past`` by a ledger: only seasons whose extracts are new or changed since are read; returns all landed rows.

    A new cutoff lands all seasons again. Seasons that can't be read keep
    their last landing and are reported.
    """
    listed, _, _ = _coverage(spark, extracts_root, team_totals_root)
    tags = ["SEASON"] if game_types is None else ["SEASON", "GAME_TYPE"]
    contract = schemas.without(schemas.RAW_GAME_LOG, "GAME_TYPE") if game_types is None else schemas.RAW_GAME_LOG

    def prepare(logs: DataFrame) -> DataFrame:
        if game_types is not None:
            logs = logs.where(F.col("GAME_TYPE").isin(list(game_types)))
        return split.past_side(_prepare(logs), cutoff)

    seasons = ledger.LandedSeasons(out_path, tags)
    result = seasons.land(spark, extracts_root, prepare, f"{cutoff}", contract, listed)
    return seasons.read(spark), result


def land_current(
    spark: SparkSession,
    extracts_root: str,
    out_path: str,
    cutoff: dt.date | str | None = None,
    season: str | None = None,
    game_types=GAME_TYPES,
) -> LandingResult:
    """Current games: the current season's extracts, from the cutoff on.

    ``season`` defaults to the latest ``SEASON=`` folder under the root (a
    listing, no data read), so the daily scan is pruned to one season instead
    of reading every extract; ``cutoff`` to that season's first game date.
    Rows without a season are read along with it: those from the cutoff on
    are landed and counted.
    """
    if season is None:
        found = landed.list_seasons(spark, extracts_root)
        if not found:
            raise split.EmptyCutoff(f"no season under {extracts_root}")
        season = found[-1]
    if cutoff is None:
        cutoff = current_cutoff(spark, extracts_root, season, game_types)
    logs = landed.read_laid_out(
        spark,
        extracts_root,
        ["SEASON"] if game_types is None else ["SEASON", "GAME_TYPE"],
        schemas.without(schemas.RAW_GAME_LOG, "GAME_TYPE") if game_types is None else schemas.RAW_GAME_LOG,
        lambda v: v[0] in (season, None) and (game_types is None or v[1] in game_types),
    )
    cur = split.current_side(_prepare(logs), cutoff)
    sinks.write_landed(cur, out_path)
    written = spark.read.parquet(out_path)
    return LandingResult(out_path, reports.rows_per_season(written), no_season=_rows_without_season(written))


def land_team_past(
    spark: SparkSession,
    team_logs_root: str,
    out_path: str,
    cutoff: dt.date | str,
    team_totals_root: str | None = None,
    on_unreadable: str = "skip",
) -> LandingResult:
    """Past team games, before the current season's first game date.

    Extracts are appended by name; with the yearly totals, their seasons
    without an extract are reported; unreadable folders as in ``land_past``.
    """
    listed, skipped, unlisted = _coverage(spark, team_logs_root, team_totals_root)
    failed: list = []
    logs = conform.parse_dates(landed.read_laid_out(spark, team_logs_root, failed=failed if on_unreadable == "skip" else None))
    if listed is not None:
        logs = logs.where(F.col("SEASON").isin(listed) | F.col("SEASON").isNull())
    past = split.past_side(logs, cutoff)
    sinks.write_landed(past, out_path)
    written = spark.read.parquet(out_path)
    return LandingResult(
        out_path, reports.rows_per_season(written), skipped, _rows_without_season(written), unlisted, _failures(spark, failed)
    )


# -------------------------------------------------------------- facts ---


def refresh_facts(
    spark: SparkSession,
    current,
    past,
    table_path: str,
    *,
    full_refresh: bool = False,
    on_duplicate: str = "error",
    on_bad_cast: str = "error",
) -> merge.MergeResult:
    """Conform both landed inputs and merge them into the fact table.

    ``on_bad_cast="error"`` (default) fails on a value that does not cast;
    ``"reject"`` writes such rows, with the failing columns named, to
    ``<table>_cast_rejects/{current,past}`` and merges the others.
    """
    cur = current if isinstance(current, DataFrame) else spark.read.parquet(current)
    pst = past if isinstance(past, DataFrame) else spark.read.parquet(past)
    if on_bad_cast == "reject":
        typed = {}
        for name, raw in (("current", cur), ("past", pst)):
            good, bad = conform.split_cast_rejects(raw)
            sinks.write_landed(bad, f"{table_path.rstrip('/')}_cast_rejects/{name}")
            typed[name] = good
        cur_t, pst_t = typed["current"], typed["past"]
    else:
        cur_t, pst_t = conform.conform_games(cur), conform.conform_games(pst)
    return merge.FactTable(table_path).merge(
        spark,
        cur_t,
        pst_t,
        full_refresh=full_refresh,
        on_duplicate=on_duplicate,
    )


def run_daily(
    spark: SparkSession,
    current_extracts: str,
    landed_current: str,
    landed_past: str,
    table_path: str,
    cutoff: dt.date | str | None = None,
    keep_versions: int = 2,
    **merge_options,
) -> tuple[LandingResult, merge.MergeResult]:
    """The daily chain: land the current season, merge it, remove what no kept version names (K4 -> K5)."""
    cur = land_current(spark, current_extracts, landed_current, cutoff)
    return cur, _merged_and_vacuumed(spark, cur.path, landed_past, table_path, keep_versions, **merge_options)


def _merged_and_vacuumed(spark, current, past, table_path, keep_versions, **merge_options) -> merge.MergeResult:
    out = refresh_facts(spark, current, past, table_path, **merge_options)
    merge.FactTable(table_path).vacuum(spark, keep=keep_versions)
    return out


def run_monthly(
    spark: SparkSession,
    history_extracts: str,
    current_extracts: str,
    landed_current: str,
    landed_past: str,
    table_path: str,
    cutoff: dt.date | str | None = None,
    team_totals_root: str | None = None,
    keep_versions: int = 2,
    **merge_options,
) -> tuple[LandingResult, merge.MergeResult]:
    """The monthly chain: land past seasons, then merge them (K3 -> K5).

    The cutoff defaults to the current extracts', as in the daily chain. A
    season that cannot be read is left out of the landing and stays in the
    table as it is; a full refresh would lose it, so that raises instead.
    """
    cut = cutoff if cutoff is not None else current_cutoff(spark, current_extracts)
    past = land_past(spark, history_extracts, landed_past, cut, team_totals_root=team_totals_root)
    if merge_options.get("full_refresh") and not past.failed.isEmpty():
        raise landed.UnreadableExtract([(r["FILE"], r["ERROR"]) for r in past.failed.limit(5).collect()])
    return past, _merged_and_vacuumed(spark, landed_current, past.path, table_path, keep_versions, **merge_options)


def union_report(spark: SparkSession, past: DataFrame, current: DataFrame, view: str | None = None) -> DataFrame:
    """Past and current by name, nulls filled, latest game through SQL.

    The union is registered as a session view (a unique name unless given, so
    concurrent calls in one session do not replace each other's view).
    """
    view = view or f"game_logs_{uuid.uuid4().hex}"
    full = conform.fill_all(combine.union_by_name(past, current))
    full.createOrReplaceTempView(view)
    # two pruned steps: the greatest date from one column, then only that date's rows
    last = spark.sql(f"SELECT max(GAME_DATE) AS d FROM {view}").first()["d"]
    where = "" if last is None else "WHERE GAME_DATE = :last"
    return spark.sql(
        f"SELECT * FROM {view} {where} ORDER BY GAME_ID, PLAYER_ID, TEAM_ID LIMIT 1", args={} if last is None else {"last": last}
    )


# ---------------------------------------------------------- dashboard ---


def dashboard(
    facts: DataFrame,
    players: DataFrame,
    teams: DataFrame,
    named_teams=(),
    k: int = 10,
    k_per_season: int = 5,
) -> dict[str, DataFrame]:
    """The report tables of the dashboard, as DataFrames.

    The totals by player and by team are staged under the shared checkpoint
    folder; ranks, trends, top lists and the comparison add up their rows, so
    the facts are not shuffled again for each of them. So are the names, of
    which those that are small enough are broadcast.
    """
    by_player = session.staged(reports.totals(facts, ["PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"]), "player-totals")
    by_team = session.staged(reports.totals(facts, ["TEAM_ID", "SEASON_YEAR", "GAME_TYPE"]), "team-totals")
    per_player = by_player.select("PLAYER_ID", "SEASON_YEAR", "GAME_TYPE", "PTS")
    per_team = by_team.select("TEAM_ID", "SEASON_YEAR", "GAME_TYPE", "PTS")
    career = by_player.groupBy("PLAYER_ID").agg(F.sum("PTS").alias("PTS"))
    per_season = by_player.groupBy("SEASON_YEAR", "PLAYER_ID").agg(F.sum("PTS").alias("PTS"))
    games = F.sum("GAMES")
    out = {
        "facts_named": reports.with_names(facts, _names(players, "FULL_NAME"), _names(teams, "FULL_NAME", "ABBREVIATION")),
        "totals_by_player": by_player,
        "totals_by_team": by_team,
        "totals_by_season_type": reports.totals(facts, ["SEASON_YEAR", "GAME_TYPE"]),
        "rank_players": reports.rank_within(per_player, ["SEASON_YEAR", "GAME_TYPE"], "PTS"),
        "rank_teams": reports.rank_within(per_team, ["SEASON_YEAR", "GAME_TYPE"], "PTS"),
        "trend_team": reports.trend(by_team, "TEAM_ID", "PTS", games=games),
        "trend_player": reports.trend(by_player, "PLAYER_ID", "PTS", games=games),
        "top_k": reports.top_k(career, "PTS", k, "PLAYER_ID"),
        "top_k_per_season": reports.top_k_per_group(per_season, ["SEASON_YEAR"], "PTS", k_per_season, "PLAYER_ID"),
    }
    if named_teams:
        out["compare_teams"] = reports.compare(by_team, "TEAM_ID", named_teams, "PTS")
    return out


#: Bytes of a dimension's names, as rows in memory, that are broadcast at most.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 64


def _names(dimension: DataFrame, *columns: str) -> DataFrame:
    """ID and names of a dimension, with a broadcast hint where they are counted to be small: facts are then joined where they are read.

    The planner guesses the size of a dimension that is a join from its inputs',
    and AQE knows it when the facts have been shuffled.
    """
    names = session.staged(dimension.select("ID", *columns), "names")
    row = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(_ROW_BYTES))
    size = names.agg(F.sum(row.cast("bigint"))).first()[0] or 0
    return F.broadcast(names) if size <= BROADCAST_BYTES else names


def write_dashboard(tables: dict[str, DataFrame], out_root: str) -> list[str]:
    paths = []
    for name, df in tables.items():
        p = f"{out_root.rstrip('/')}/{name}"
        with session.for_writes(df.sparkSession):
            sinks.write_table(df, p)
        paths.append(p)
    return paths
