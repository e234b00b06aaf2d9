"""Registered queries over the driver's tables, and their DuckDB oracles.

Job queries land and merge under the session's scratch folder and return what
was written. Every query reads the whole proxy tables (no id subsets, no row caps); a
``limit`` appears only where it is the feature (the test-run sample, the
latest game, top-k reports). Spark plans are built from the library's
operators; each oracle is hand-written DuckDB SQL over the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import schemas, session
from courtline.functions import columns as fn
from courtline.operators import combine, conform, merge, reports, split, totals
from courtline.plans import jobs, proxy
from courtline.sources import Registry, landed, storage

Builder = Callable[[SparkSession, str], DataFrame]

# ------------------------------------------------------------ Spark side ---


def _games(spark, d):
    return proxy.game_logs(spark, d)


def _stored_games(spark, d):
    """The game logs for a query that reads them several times: joined once."""
    return proxy.game_logs(spark, d, stored=True)


def _sides(spark, d, g=None):
    g = _games(spark, d) if g is None else g
    cut = split.cutoff_value(g)
    return split.current_side(g, cut), split.past_side(g, cut)


def _landed(raw: DataFrame) -> DataFrame:
    """Landing shape: fill FTA, REB, AST, PF and parse GAME_DATE."""
    return conform.parse_dates(conform.fill_stats(raw))


def _typed_sides(spark, d, g=None):
    cur, past = _sides(spark, d, g)
    return conform.conform_games(cur, stamp=False), conform.conform_games(past, stamp=False)


def _facts(spark, d, g=None):
    """Content of the fact table after a first run (every dated game row)."""
    g = _games(spark, d) if g is None else g
    return conform.conform_games(g.where(F.col("GAME_DATE").isNotNull()), stamp=False)


def _target(typed: DataFrame) -> DataFrame:
    """A prior fact table: games with an even id, PTS one higher.

    Built from all dated games, which are the rows of the typed union.
    """
    return typed.where(F.col("GAME_ID") % 2 == 0).withColumn("PTS", F.col("PTS") + 1)


def q_current_games(spark, d):
    return _typed_sides(spark, d)[0]


def q_past_games(spark, d):
    return _typed_sides(spark, d)[1]


def q_first_game_date(spark, d):
    return split.first_game_date(_games(spark, d))


def q_typed_union(spark, d):
    cur, past = _typed_sides(spark, d)
    return combine.union_all(cur, past)


def q_latest_game(spark, d):
    cur, past = _sides(spark, d)
    return jobs.union_report(spark, _landed(past), _landed(cur))


def q_dim_players(spark, d):
    return conform.conform_players(proxy.players(spark, d), stamp=False)


def q_dim_teams(spark, d):
    return conform.conform_teams(proxy.teams(spark, d), stamp=False)


def q_seasons(spark, d):
    return split.seasons(proxy.team_year_totals(_games(spark, d)))


def q_union_by_name(spark, d):
    cur, past = _sides(spark, d)
    return combine.union_by_name(_landed(past).drop("GAME_TYPE"), _landed(cur))


def _holes(c: str):
    """A statistic with null for 1 and NaN, as extracts carry missing values, for 2."""
    return F.when(F.col(c) == 1, F.lit(None)).when(F.col(c) == 2, F.lit(float("nan"))).otherwise(F.col(c))


def q_filled_all(spark, d):
    g = _games(spark, d).withColumns({c: _holes(c) for c in ("FGM", "STL")})
    return conform.fill_all(g.withColumn("WL", F.expr("nullif(WL, 'W')"))).select(*schemas.KEY_COLUMNS, "GAME_DATE", "FGM", "STL", "WL")


def q_filled_stats(spark, d):
    g = _games(spark, d).withColumns({c: _holes(c) for c in schemas.FILL_ZERO_STATS})
    return conform.fill_stats(g).select(*schemas.KEY_COLUMNS, *schemas.FILL_ZERO_STATS, "PTS")


def q_skipped_seasons(spark, d):
    found = split.seasons(proxy.team_year_totals(_games(spark, d)))
    return reports.skipped_seasons(proxy.requested_seasons(spark), found)


def q_new_past_keys(spark, d):
    g = _stored_games(spark, d)
    cur, past = _typed_sides(spark, d, g)
    return merge.new_keys(past, _target(_facts(spark, d, g)))


def q_merged_facts(spark, d):
    g = _stored_games(spark, d)
    cur, past = _typed_sides(spark, d, g)
    return merge.merge_plan(_target(_facts(spark, d, g)), cur, past)


def q_sample_run(spark, d):
    return merge.sample_limit(q_typed_union(spark, d), 500)


def q_rows_per_season(spark, d):
    return reports.rows_per_season(_games(spark, d))


def q_running_rows(spark, d):
    return reports.running_rows(_games(spark, d))


def q_facts_named(spark, d):
    named = reports.with_names(_facts(spark, d), q_dim_players(spark, d), q_dim_teams(spark, d))
    return named.select(
        "PLAYER_ID", "GAME_ID", "TEAM_ID", "GAME_DATE", "SEASON_YEAR", "GAME_TYPE", "PTS",
        "PLAYER_NAME", "TEAM_NAME", "TEAM_ABBREVIATION",
    )


def q_totals_by_player(spark, d):
    return reports.totals(_facts(spark, d), ["PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"])


def q_totals_by_team(spark, d):
    return reports.totals(_facts(spark, d), ["TEAM_ID", "SEASON_YEAR", "GAME_TYPE"])


def q_totals_by_season_type(spark, d):
    return reports.totals(_facts(spark, d), ["SEASON_YEAR", "GAME_TYPE"])


def q_compare_teams(spark, d):
    return reports.compare(_facts(spark, d), "TEAM_ID", proxy.COMPARED_TEAMS, "PTS")


def _player_season_pts(spark, d, by=("PLAYER_ID", "SEASON_YEAR", "GAME_TYPE")):
    return _facts(spark, d).groupBy(*by).agg(F.sum("PTS").alias("PTS"))


def q_rank_players(spark, d):
    per = session.staged(_player_season_pts(spark, d), "player-points")  # the ranks read it twice
    return reports.rank_within(per, ["SEASON_YEAR", "GAME_TYPE"], "PTS")


def q_rank_teams(spark, d):
    per_team = _player_season_pts(spark, d, ("TEAM_ID", "SEASON_YEAR", "GAME_TYPE"))
    return reports.rank_within(session.staged(per_team, "team-points"), ["SEASON_YEAR", "GAME_TYPE"], "PTS")


def q_trend_team(spark, d):
    return reports.trend(_facts(spark, d), "TEAM_ID", "PTS")


def q_trend_player(spark, d):
    return reports.trend(_facts(spark, d), "PLAYER_ID", "PTS")


def q_top_k(spark, d):
    return reports.top_k(_player_season_pts(spark, d, ("PLAYER_ID",)), "PTS", 10, "PLAYER_ID")


def q_top_k_per_season(spark, d):
    per = _player_season_pts(spark, d, ("SEASON_YEAR", "PLAYER_ID"))
    return reports.top_k_per_group(per, ["SEASON_YEAR"], "PTS", 5, "PLAYER_ID")


# ------------------------------------------------------------------ jobs ---


def _scratch(spark, name):
    return session.scratch_path(spark, name)


def _extracts(spark, d, root, games=None, tags=("SEASON", "GAME_TYPE")):
    """Landed extracts as the feeds are: the latest season in a root of its own."""
    g = _stored_games(spark, d) if games is None else games
    latest = g.agg(F.max("SEASON")).first()[0]
    for name, side in (("history", g.where(F.col("SEASON") != latest)), ("current", g.where(F.col("SEASON") == latest))):
        side.write.partitionBy(*tags).parquet(f"{root}/{name}")
    return f"{root}/history", f"{root}/current"


def q_landed_past(spark, d):
    root = _scratch(spark, "landed-past")
    history, current = _extracts(spark, d, root)
    out = jobs.land_past(spark, history, f"{root}/out", jobs.current_cutoff(spark, current))
    return spark.read.parquet(out.path)


def q_landed_current(spark, d):
    root = _scratch(spark, "landed-current")
    _, current = _extracts(spark, d, root)
    return spark.read.parquet(jobs.land_current(spark, current, f"{root}/out").path)


def q_landed_without_type(spark, d):
    root = _scratch(spark, "landed-without-type")
    history, current = _extracts(spark, d, root, _stored_games(spark, d).drop("GAME_TYPE"), ("SEASON",))
    cut = jobs.current_cutoff(spark, current, game_types=None)
    cur = jobs.land_current(spark, current, f"{root}/cur", game_types=None)
    past = jobs.land_past(spark, history, f"{root}/past", cut, game_types=None)
    return combine.union_by_name(*(spark.read.parquet(r.path) for r in (cur, past)))


def q_landed_mixed(spark, d):
    """Odd seasons carry integer statistics, text dates and a column of their own."""
    root = _scratch(spark, "landed-mixed")
    g = _stored_games(spark, d)
    odd = g.where("cast(SEASON as int) % 2 = 1").withColumns(
        {c: F.col(c).cast("bigint") for c in ("FGM", "OREB", "PTS", "FTA", "PF")}
        | {"GAME_DATE": F.date_format("GAME_DATE", "yyyy-MM-dd'T'HH:mm:ss"), "PLAYER_NAME": F.concat(F.lit("player "), F.col("PLAYER_ID").cast("string"))}
    )
    for side in (odd, g.where("cast(SEASON as int) % 2 = 0")):
        side.write.mode("append").partitionBy("SEASON", "GAME_TYPE").parquet(f"{root}/ext")
    cut = jobs.current_cutoff(spark, f"{root}/ext")
    past = jobs.land_past(spark, f"{root}/ext", f"{root}/past", cut)
    cur = jobs.land_current(spark, f"{root}/ext", f"{root}/cur", cut)
    return combine.union_by_name(*(spark.read.parquet(r.path) for r in (past, cur)))


def q_landed_mixed_folders(spark, d):
    """Files of two schemas within each folder of a season: numbers or integers, date-times or text, a column that one has."""
    root = _scratch(spark, "landed-mixed-folders")
    g = _stored_games(spark, d)
    odd = "cast(GAME_ID as bigint) % 2 = 1"
    other = g.where(odd).withColumns(
        {c: F.col(c).cast("bigint") for c in ("FGM", "OREB", "PTS", "FTA", "PF")}
        | {"GAME_DATE": F.date_format("GAME_DATE", "yyyy-MM-dd'T'HH:mm:ss"), "PLAYER_NAME": F.concat(F.lit("player "), F.col("PLAYER_ID").cast("string"))}
    )
    for side in (other, g.where(f"NOT ({odd})")):
        side.write.mode("append").partitionBy("SEASON", "GAME_TYPE").parquet(f"{root}/ext")
    cut = jobs.current_cutoff(spark, f"{root}/ext")
    past = jobs.land_past(spark, f"{root}/ext", f"{root}/past", cut)
    cur = jobs.land_current(spark, f"{root}/ext", f"{root}/cur", cut)
    return combine.union_by_name(*(spark.read.parquet(r.path) for r in (past, cur)))


def q_landed_incremental(spark, d):
    """A second landing after one season's extracts were corrected and another's were added: it reads these two."""
    root = _scratch(spark, "landed-incremental")
    g = _stored_games(spark, d)
    names = [r["SEASON"] for r in split.seasons(proxy.team_year_totals(g)).collect()]
    first, last = names[0], names[-2]
    cut = split.cutoff_value(g)
    wrong = g.where(F.col("SEASON") != last).withColumn("PTS", F.when(F.col("SEASON") == first, F.col("PTS") + 1).otherwise(F.col("PTS")))
    wrong.write.partitionBy("SEASON", "GAME_TYPE").parquet(f"{root}/ext")
    jobs.land_past_changes(spark, f"{root}/ext", f"{root}/out", cut)
    storage.delete(spark, f"{root}/ext/SEASON={first}")
    g.where(F.col("SEASON").isin(first, last)).write.mode("append").partitionBy("SEASON", "GAME_TYPE").parquet(f"{root}/ext")
    rows, result = jobs.land_past_changes(spark, f"{root}/ext", f"{root}/out", cut)
    return rows.withColumn("READ_AGAIN", F.col("SEASON").isin(result.landed))


def q_landed_with_failure(spark, d):
    """Past seasons of which one has a file that is no Parquet: it is left out and reported, the others land."""
    root = _scratch(spark, "landed-with-failure")
    history, current = _extracts(spark, d, root)
    broken = landed.list_seasons(spark, history)[1]
    storage.write_text(spark, f"{history}/SEASON={broken}/GAME_TYPE=Playoffs/part-broken.parquet", "not a Parquet file")
    out = jobs.land_past(spark, history, f"{root}/out", jobs.current_cutoff(spark, current))
    rows = spark.read.parquet(out.path).groupBy("SEASON", "GAME_TYPE").agg(F.count(F.lit(1)).alias("N_ROWS"), F.sum("PTS").alias("PTS"))
    failed = out.failed.groupBy("SEASON").agg(F.count(F.lit(1)).alias("N_FAILED"))
    return rows.join(failed, "SEASON", "full").withColumn("N_FAILED", F.coalesce("N_FAILED", F.lit(0).cast("bigint")))


def _team_logs(g):
    return g.select("TEAM_ID", "GAME_ID", "GAME_DATE", "SEASON", F.lit("home").alias("SIDE")).distinct()


def q_landed_team_past(spark, d):
    """Team logs by name: even seasons have text dates and no SIDE."""
    root = _scratch(spark, "landed-team-past")
    g = _stored_games(spark, d)
    _, current = _extracts(spark, d, root, g)
    logs = _team_logs(g)
    even = logs.where("cast(SEASON as int) % 2 = 0").drop("SIDE")
    even = even.withColumn("GAME_DATE", F.date_format("GAME_DATE", "yyyy-MM-dd'T'HH:mm:ss"))
    for side in (even, logs.where("cast(SEASON as int) % 2 = 1")):
        side.write.mode("append").partitionBy("SEASON").parquet(f"{root}/teams")
    out = jobs.land_team_past(spark, f"{root}/teams", f"{root}/out", jobs.current_cutoff(spark, current))
    return spark.read.parquet(out.path)


#: Folders that the teams' yearly totals lie in: a folder for each team would be as many files as there are teams.
TEAM_GROUPS = 64


def q_landed_seasons(spark, d):
    root = _scratch(spark, "team-totals")
    totals_by_year = proxy.team_year_totals(_games(spark, d)).withColumn("TEAM_GROUP", F.pmod("TEAM_ID", F.lit(TEAM_GROUPS)))
    totals_by_year.repartition("TEAM_GROUP").write.partitionBy("TEAM_GROUP").parquet(root)
    return split.seasons(landed.read_team_year_totals(spark, root))


def q_merge_job_result(spark, d):
    """Create from the even games with one point more, then merge both sides."""
    root = _scratch(spark, "merge-job")
    g = _stored_games(spark, d)
    cut = split.cutoff_value(g)
    prior = g.where("cast(GAME_ID as bigint) % 2 = 0").withColumn("PTS", F.col("PTS") + 1)
    jobs.refresh_facts(spark, g.where("false"), prior, f"{root}/facts", on_duplicate="latest")
    jobs.refresh_facts(spark, split.current_side(g, cut), split.past_side(g, cut), f"{root}/facts", on_duplicate="latest")
    table = merge.FactTable(f"{root}/facts").read(spark)
    return table.withColumn("STAMPED", F.col("LAST_UPDATE").isNotNull()).drop("LAST_UPDATE")


def q_totals_incremental(spark, d):
    """Player totals kept up to date over three merges: even games with one point more, then the past, then the current side."""
    root = _scratch(spark, "totals-incremental")
    g = _stored_games(spark, d)
    cut = split.cutoff_value(g)
    none = g.where("false")
    prior = g.where("cast(GAME_ID as bigint) % 2 = 0").withColumn("PTS", F.col("PTS") + 1)
    table, kept = merge.FactTable(f"{root}/facts"), totals.TotalsTable(f"{root}/totals", ["PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"])
    for current, past in ((none, prior), (none, split.past_side(g, cut)), (split.current_side(g, cut), none)):
        jobs.refresh_facts(spark, current, past, table.path, on_duplicate="latest")
        kept.refresh(spark, table)
    return kept.read(spark)


def _stamped(df):
    return df.withColumn("STAMPED", F.col("LAST_UPDATE").isNotNull()).drop("LAST_UPDATE")


#: What a dashboard table is checked by: the entity's columns and the table's figures.
DASHBOARD = {
    "facts_named": ("concat_ws('/', PLAYER_NAME, TEAM_NAME, TEAM_ABBREVIATION, GAME_ID)", {"PTS": "PTS"}),
    "totals_by_player": ("concat_ws('/', PLAYER_ID, GAME_TYPE)", {"GAMES": "GAMES", "PTS": "PTS"}),
    "totals_by_team": ("concat_ws('/', TEAM_ID, GAME_TYPE)", {"GAMES": "GAMES", "PTS": "PTS"}),
    "totals_by_season_type": ("GAME_TYPE", {"GAMES": "GAMES", "PTS": "PTS"}),
    "rank_players": ("concat_ws('/', PLAYER_ID, GAME_TYPE)", {"PTS": "PTS", "PLACE": "PTS_RANK"}),
    "rank_teams": ("concat_ws('/', TEAM_ID, GAME_TYPE)", {"PTS": "PTS", "PLACE": "PTS_RANK"}),
    "trend_team": ("cast(TEAM_ID as string)", {"GAMES": "GAMES", "PTS": "PTS_CHANGE"}),
    "trend_player": ("cast(PLAYER_ID as string)", {"GAMES": "GAMES", "PTS": "PTS_CHANGE"}),
    "top_k": ("cast(PLAYER_ID as string)", {"PTS": "PTS"}),
    "top_k_per_season": ("cast(PLAYER_ID as string)", {"PTS": "PTS", "PLACE": "POS"}),
    "compare_teams": ("'1/2/3'", {"GAMES": "TEAM_1_PTS", "PTS": "TEAM_2_PTS", "PLACE": "TEAM_3_PTS"}),
}


def q_dashboard_tables(spark, d):
    """Every table of the dashboard job as it was written, one row for each of its rows."""
    root = _scratch(spark, "dashboard")
    with session.for_writes(spark):
        _facts(spark, d).write.option("compression", session.codec(spark)).parquet(f"{root}/facts")
    tables = jobs.dashboard(
        spark.read.parquet(f"{root}/facts"), q_dim_players(spark, d), q_dim_teams(spark, d), proxy.COMPARED_TEAMS
    )
    parts = []
    for path in jobs.write_dashboard(tables, f"{root}/out"):
        name = path.rsplit("/", 1)[1]
        df = spark.read.parquet(path)
        entity, figures = DASHBOARD[name]
        season = "SEASON_YEAR" if "SEASON_YEAR" in df.columns else "cast(null as string)"
        parts.append(
            df.selectExpr(
                f"'{name}' as TABLE_NAME",
                f"{season} as SEASON_YEAR",
                f"{entity} as ENTITY",
                *[f"cast({figures.get(c, 'null')} as bigint) as {c}" for c in ("GAMES", "PTS", "PLACE")],
            )
        )
    return combine.union_all(*parts)


def q_refreshed_players(spark, d):
    root = _scratch(spark, "players")
    proxy.players(spark, d).write.json(f"{root}/list")
    return _stamped(jobs.refresh_players(spark, f"{root}/list", f"{root}/dim", fmt="json"))


def q_refreshed_teams(spark, d):
    root = _scratch(spark, "teams")
    proxy.teams(spark, d).write.parquet(f"{root}/teams")
    staged = Registry.under(spark, root, names=["teams"]).table("teams", check=True)
    return _stamped(jobs.refresh_teams(spark, staged, f"{root}/dim"))


def q_staging_view(spark, d):
    root = _scratch(spark, "staging")
    _landed(_games(spark, d)).write.parquet(f"{root}/player_games_past")
    prefix = f"stg_{uuid.uuid4().hex}_"
    (view,) = Registry.under(spark, root, names=["player_games_past"]).register_views(prefix=prefix)
    return spark.sql(f"SELECT PLAYER_ID, GAME_ID, TEAM_ID, PTS FROM {view}")


def q_enforced_schema(spark, d):
    g = _games(spark, d).drop("BLKA").withColumns({"OTHER": F.lit(1), "PTS": F.col("PTS").cast("int")})
    return conform.enforce_schema(g, schemas.RAW_GAME_LOG, fill_missing=True)


def q_year_starts(spark, d):
    return _facts(spark, d).select(
        *schemas.KEY_COLUMNS, fn.year_start("GAME_DATE").alias("YEAR_START"), fn.game_year("GAME_DATE").alias("GAME_YEAR")
    )


QUERIES: dict[str, Builder] = {
    "current_games": q_current_games,
    "past_games": q_past_games,
    "first_game_date": q_first_game_date,
    "typed_union": q_typed_union,
    "latest_game": q_latest_game,
    "dim_players": q_dim_players,
    "dim_teams": q_dim_teams,
    "seasons": q_seasons,
    "union_by_name": q_union_by_name,
    "filled_stats": q_filled_stats,
    "skipped_seasons": q_skipped_seasons,
    "new_past_keys": q_new_past_keys,
    "merged_facts": q_merged_facts,
    "sample_run": q_sample_run,
    "rows_per_season": q_rows_per_season,
    "running_rows": q_running_rows,
    "facts_named": q_facts_named,
    "totals_by_player": q_totals_by_player,
    "totals_by_team": q_totals_by_team,
    "totals_by_season_type": q_totals_by_season_type,
    "compare_teams": q_compare_teams,
    "rank_players": q_rank_players,
    "rank_teams": q_rank_teams,
    "trend_team": q_trend_team,
    "trend_player": q_trend_player,
    "top_k": q_top_k,
    "top_k_per_season": q_top_k_per_season,
    "filled_all": q_filled_all,
    "landed_past": q_landed_past,
    "landed_current": q_landed_current,
    "landed_without_type": q_landed_without_type,
    "landed_mixed": q_landed_mixed,
    "landed_mixed_folders": q_landed_mixed_folders,
    "landed_with_failure": q_landed_with_failure,
    "landed_incremental": q_landed_incremental,
    "landed_team_past": q_landed_team_past,
    "landed_seasons": q_landed_seasons,
    "merge_job_result": q_merge_job_result,
    "totals_incremental": q_totals_incremental,
    "refreshed_players": q_refreshed_players,
    "refreshed_teams": q_refreshed_teams,
    "staging_view": q_staging_view,
    "enforced_schema": q_enforced_schema,
    "year_starts": q_year_starts,
    "dashboard_tables": q_dashboard_tables,
}
