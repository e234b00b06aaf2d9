import os
import random

import pytest
from pyspark.sql import functions as F

from courtline import schemas
from courtline.operators import conform, merge, reports, split
from courtline.plans import jobs, proxy
from courtline.sources import Registry, landed, storage
from tests.conftest import SF_SMALL


def _lay_out_extracts(spark, root):
    """Write the proxy game logs as per-season / per-game-type extracts."""
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG)
    g.write.mode("overwrite").partitionBy("SEASON", "GAME_TYPE").parquet(root)
    return g


def _lay_out_team_years(spark, root, games, extra_seasons=("1994",)):
    ty = proxy.team_year_totals(games)
    extra = spark.createDataFrame([(0, s) for s in extra_seasons], schemas.TEAM_YEAR_TOTALS)
    ty.unionByName(extra).write.mode("overwrite").partitionBy("TEAM_ID").parquet(root)


def test_landing_past_and_current_from_extracts(spark, tmp_dir):
    ext = os.path.join(tmp_dir, "extracts")
    ty = os.path.join(tmp_dir, "team_years")
    g = _lay_out_extracts(spark, ext)
    _lay_out_team_years(spark, ty, g)

    cut = jobs.current_cutoff(spark, ext)
    past = jobs.land_past(spark, ext, os.path.join(tmp_dir, "landed_past"), cut, team_totals_root=ty)
    cur = jobs.land_current(spark, ext, os.path.join(tmp_dir, "landed_current"))
    n_past = spark.read.parquet(past.path).count()
    n_cur = spark.read.parquet(cur.path).count()
    assert n_past + n_cur == g.count()
    # The season listed in the yearly totals without an extract is reported.
    assert [r.SEASON for r in past.skipped.collect()] == ["1994"]
    # Running total by season ends at the number of past rows.
    last = past.rows.orderBy(F.col("SEASON").desc()).first()
    assert last.TOTAL_ROWS == n_past
    # Landing shape: the four filled stats are integers.
    types = dict(spark.read.parquet(past.path).dtypes)
    assert all(types[c] == "bigint" for c in schemas.FILL_ZERO_STATS)

    # K5 then K8 on the landed files.
    table = os.path.join(tmp_dir, "facts")
    res = jobs.refresh_facts(spark, cur.path, past.path, table, on_duplicate="latest")
    assert res.mode == "create"
    facts = merge.FactTable(table).read(spark)
    n_facts = facts.count()
    assert n_facts == facts.select("PLAYER_ID", "GAME_ID", "TEAM_ID").distinct().count()
    res2 = jobs.refresh_facts(spark, cur.path, past.path, table, on_duplicate="latest")
    assert res2.mode == "incremental"
    assert merge.FactTable(table).read(spark).count() == n_facts

    latest = jobs.union_report(spark, spark.read.parquet(past.path), spark.read.parquet(cur.path)).first()
    assert latest.GAME_DATE == spark.read.parquet(cur.path).agg(F.max("GAME_DATE")).first()[0]


def test_landing_without_game_type(spark, tmp_dir):
    ext = os.path.join(tmp_dir, "extracts_by_season")
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG).drop("GAME_TYPE")
    g.write.mode("overwrite").partitionBy("SEASON").parquet(ext)
    res = jobs.land_current(spark, ext, os.path.join(tmp_dir, "cur"), game_types=None)
    df = spark.read.parquet(res.path)
    assert "GAME_TYPE" not in df.columns and df.count() > 0


def test_team_logs_landing(spark, tmp_dir):
    """By-name append: one season lacks a column, one has text dates; a listed season has no extract."""
    root, ty = os.path.join(tmp_dir, "team_logs"), os.path.join(tmp_dir, "team_years")
    games = proxy.game_logs(spark, SF_SMALL)
    g = games.select("TEAM_ID", "GAME_ID", "GAME_DATE", "SEASON", F.lit("x").alias("SIDE")).distinct()
    latest = g.agg(F.max("SEASON")).first()[0]
    text = F.date_format("GAME_DATE", "yyyy-MM-dd'T'HH:mm:ss")
    g.where(F.col("SEASON") == latest).withColumn("GAME_DATE", text).write.partitionBy("SEASON").parquet(root)
    g.where((F.col("SEASON") != latest) & (F.col("SEASON") != "1996")).withColumn("GAME_DATE", text).write.mode("append").partitionBy("SEASON").parquet(root)
    g.where(F.col("SEASON") == "1996").drop("SIDE").write.mode("append").partitionBy("SEASON").parquet(root)
    _lay_out_team_years(spark, ty, games)
    cut = g.where(F.col("SEASON") == latest).agg(F.min("GAME_DATE")).first()[0].date()
    res = jobs.land_team_past(spark, root, os.path.join(tmp_dir, "team_past"), cut, team_totals_root=ty)
    out = spark.read.parquet(res.path)
    assert dict(out.dtypes)["GAME_DATE"] == "timestamp_ntz"
    assert dict(out.dtypes)["SEASON"] == "string"
    assert out.where(F.col("SEASON") == latest).count() == 0
    assert out.count() == g.where(F.col("SEASON") < latest).count()
    assert out.where("SIDE IS NULL").count() == g.where("SEASON = '1996'").count()
    assert [r.SEASON for r in res.skipped.collect()] == ["1994"]


def test_two_roots_share_the_current_cutoff(spark, tmp_dir):
    """The last finished season lands in the past, whichever roots the feeds have; a null season is counted."""
    from tests.fixtures import frame, game

    rows = [
        game(game_id="0000000001", date="2021-11-01", season="2021-22"),
        game(game_id="0000000002", date="2022-11-01", season="2022-23"),
        game(game_id="0000000003", date="2023-10-24", season="2023-24"),
        game(game_id="0000000004", date="2023-10-25", season="2023-24"),
        game(game_id="0000000005", date="2022-12-01", season=None),
        game(game_id="0000000006", date="2023-12-01", season=None),
        game(game_id="0000000007", date=None, season="2023-24"),
    ]
    g = frame(spark, rows)
    hist, curr = os.path.join(tmp_dir, "history"), os.path.join(tmp_dir, "current")
    g.where("GAME_ID IN ('0000000001', '0000000002', '0000000005')").write.partitionBy("SEASON", "GAME_TYPE").parquet(hist)
    g.where("GAME_ID NOT IN ('0000000001', '0000000002', '0000000005')").write.partitionBy("SEASON", "GAME_TYPE").parquet(curr)
    cur = jobs.land_current(spark, curr, os.path.join(tmp_dir, "cur"))
    past, _ = jobs.run_monthly(spark, hist, curr, cur.path, os.path.join(tmp_dir, "past"), os.path.join(tmp_dir, "facts"))
    ids = [{int(r.GAME_ID) for r in spark.read.parquet(x.path).collect()} for x in (past, cur)]
    assert ids == [{1, 2, 5}, {3, 4, 6}]
    assert (past.no_season, cur.no_season) == (1, 1)
    assert merge.FactTable(os.path.join(tmp_dir, "facts")).read(spark).count() == 6


def test_an_empty_cutoff_writes_nothing(spark, tmp_dir):
    from tests.fixtures import frame, game

    ext, out = os.path.join(tmp_dir, "ext"), os.path.join(tmp_dir, "cur")
    frame(spark, [game(season=None), game(date=None)]).write.partitionBy("SEASON", "GAME_TYPE").parquet(ext)
    with pytest.raises(split.EmptyCutoff):
        jobs.land_current(spark, ext, out)
    with pytest.raises(split.EmptyCutoff):
        jobs.land_past(spark, ext, out, None)
    assert not os.path.exists(out)


def test_extracts_as_the_feeds_are(spark, tmp_dir):
    """Integer statistics, text dates, extra and absent columns, NaN."""
    from tests.fixtures import frame, game

    ext = os.path.join(tmp_dir, "ext")
    a = frame(spark, [game(game_id="0000000001", date="2021-11-01", season="2021-22")])
    a = a.withColumns({"FTA": F.col("FTA").cast("bigint"), "GAME_DATE": F.lit("2021-11-01T00:00:00"), "PLAYER_NAME": F.lit("Ann")}).drop("BLKA")
    b = frame(spark, [game(game_id="0000000002", date="2023-11-01", FTA=float("nan"), PTS=float("nan"))])
    for x in (a, b):
        x.write.mode("append").partitionBy("SEASON", "GAME_TYPE").parquet(ext)
    cut = jobs.current_cutoff(spark, ext)
    past = spark.read.parquet(jobs.land_past(spark, ext, os.path.join(tmp_dir, "past"), cut).path).first()
    cur = spark.read.parquet(jobs.land_current(spark, ext, os.path.join(tmp_dir, "cur"), cut).path)
    assert (past.PLAYER_NAME, past.BLKA, past.FTA, str(past.GAME_DATE)) == ("Ann", None, 2, "2021-11-01 00:00:00")
    assert cur.first().FTA == 0
    assert conform.conform_games(cur).first().PTS is None


def test_landing_replaces_the_whole_object(spark, tmp_dir):
    from courtline.sources import sinks

    path = os.path.join(tmp_dir, "landed")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, p string")
    sinks.write_landed(df, path, partition_by=["p"])
    sinks.write_landed(df.where("p = 'b'"), path, partition_by=["p"])
    assert [r.p for r in spark.read.parquet(path).collect()] == ["b"]


def test_dimension_refresh_and_registry(spark, tmp_dir):
    src = os.path.join(tmp_dir, "staging")
    proxy.players(spark, SF_SMALL).write.mode("overwrite").parquet(os.path.join(src, "players"))
    proxy.teams(spark, SF_SMALL).write.mode("overwrite").parquet(os.path.join(src, "teams"))
    reg = Registry.under(spark, src, names=["players", "teams"])
    assert sorted(reg.register_views(prefix="stg_")) == ["stg_players", "stg_teams"]
    assert spark.sql("select count(*) from stg_players").first()[0] == proxy.players(spark, SF_SMALL).count()
    p = jobs.refresh_players(spark, reg.table("players"), os.path.join(tmp_dir, "dim_players"))
    t = jobs.refresh_teams(spark, reg.table("teams"), os.path.join(tmp_dir, "dim_teams"))
    assert p.columns == schemas.names(schemas.PLAYERS)
    assert t.columns == schemas.names(schemas.TEAMS) and t.count() == proxy.teams(spark, SF_SMALL).count()


def test_dashboard_tables(spark, tmp_dir):
    facts = conform.conform_games(proxy.game_logs(spark, SF_SMALL), stamp=False)
    players = conform.conform_players(proxy.players(spark, SF_SMALL), stamp=False)
    teams = conform.conform_teams(proxy.teams(spark, SF_SMALL), stamp=False)
    tables = jobs.dashboard(facts, players, teams, named_teams=(1, 2))
    paths = jobs.write_dashboard(tables, os.path.join(tmp_dir, "dash"))
    assert len(paths) == len(tables)
    assert spark.read.parquet(paths[0]).count() == facts.count()
    assert tables["top_k"].count() == 10
    assert sorted(tables) == [
        "compare_teams", "facts_named", "rank_players", "rank_teams", "top_k", "top_k_per_season",
        "totals_by_player", "totals_by_season_type", "totals_by_team", "trend_player", "trend_team",
    ]


def test_dashboard_adds_up_staged_totals(spark, tmp_dir):
    """Null points and keys count as in the facts; those tables read the staged totals only."""
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), rng.choice(["2001", "2002", "2003", None]), rng.choice(["A", "B", None]), rng.choice([None, 0, 5, 7]))
        for _ in range(120)
    ]
    stats = [F.lit(1).cast("bigint").alias(m) for m in reports.SUM_METRICS if m != "PTS"]
    at = os.path.join(tmp_dir, "facts")
    facts = spark.createDataFrame(rows, "PLAYER_ID long, TEAM_ID long, SEASON_YEAR string, GAME_TYPE string, PTS long")
    facts.select("*", *stats, F.lit("W").alias("WL"), F.lit("1").alias("GAME_ID")).write.parquet(at)
    facts = spark.read.parquet(at)
    names = spark.createDataFrame([(1, "one", "ONE")], "ID long, FULL_NAME string, ABBREVIATION string")
    tables = jobs.dashboard(facts, names, names, named_teams=(1, 2), k=4, k_per_season=4)
    reads = {n for n, t in tables.items() if any(f.startswith(f"file://{at}/") for f in t.inputFiles())}
    assert reads == {"facts_named", "totals_by_season_type"}
    per = lambda *by: facts.groupBy(*by).agg(F.sum("PTS").alias("PTS"))
    want = {
        "trend_team": reports.trend(facts, "TEAM_ID"),
        "trend_player": reports.trend(facts, "PLAYER_ID"),
        "rank_players": reports.rank_within(per("PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"), ["SEASON_YEAR", "GAME_TYPE"], "PTS"),
        "rank_teams": reports.rank_within(per("TEAM_ID", "SEASON_YEAR", "GAME_TYPE"), ["SEASON_YEAR", "GAME_TYPE"], "PTS"),
        "top_k": reports.top_k(per("PLAYER_ID"), "PTS", 4, "PLAYER_ID"),
        "top_k_per_season": reports.top_k_per_group(per("SEASON_YEAR", "PLAYER_ID"), ["SEASON_YEAR"], "PTS", 4, "PLAYER_ID"),
        "compare_teams": reports.compare(facts, "TEAM_ID", (1, 2)),
    }
    for name, df in want.items():
        assert tables[name].columns == df.columns
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, df.collect())), name


def test_dashboard_names_are_broadcast_where_they_are_small(spark, tmp_dir, monkeypatch):
    """By a count of their bytes, whatever the planner guesses; beyond it by a join of shuffled rows, with the same result."""
    at = os.path.join(tmp_dir, "facts")
    rows = [(p, t) for p in (1, 2, 3, None) for t in (1, 2, None)]
    facts = spark.createDataFrame(rows, "PLAYER_ID long, TEAM_ID long").select(
        "*", F.lit("2001").alias("SEASON_YEAR"), F.lit("A").alias("GAME_TYPE"), F.lit("W").alias("WL"), *[F.lit(1).cast("bigint").alias(m) for m in reports.SUM_METRICS]
    )
    facts.write.parquet(at)
    facts = spark.read.parquet(at)
    names = spark.createDataFrame([(1, "one", "ONE"), (2, None, None), (2, "two", "TWO"), (None, "none", "NO")], "ID long, FULL_NAME string, ABBREVIATION string")
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in limits]
    found = []
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        for most, join in ((jobs.BROADCAST_BYTES, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            monkeypatch.setattr(jobs, "BROADCAST_BYTES", most)
            named = jobs.dashboard(facts, names, names)["facts_named"]
            assert named._jdf.queryExecution().executedPlan().toString().count(join) == 2
            found.append(sorted(map(str, named.collect())))
    finally:
        for k, v in zip(limits, before, strict=True):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert found[0] == found[1] == sorted(map(str, reports.with_names(facts, names, names).collect()))


def test_refresh_facts_rejects_bad_casts(spark, tmp_dir):
    from tests.fixtures import frame, game

    cur = frame(spark, [game(game_id="0000000001"), game(game_id="0000000x02")])
    past = frame(spark, [game(game_id="0000000003", date="2023-03-01", season="2022-23")])
    table = os.path.join(tmp_dir, "facts")
    res = jobs.refresh_facts(spark, cur, past, table, on_bad_cast="reject")
    assert res.incoming_rows == 2
    rej = spark.read.parquet(table + "_cast_rejects/current")
    assert [r.GAME_ID for r in rej.collect()] == ["0000000x02"]
    assert spark.read.parquet(table + "_cast_rejects/past").count() == 0


def test_daily_and_monthly_chains(spark, tmp_dir):
    ext = os.path.join(tmp_dir, "extracts")
    _lay_out_extracts(spark, ext)
    paths = {n: os.path.join(tmp_dir, n) for n in ("cur", "past", "facts")}
    # The monthly chain needs a landed current extract; land it first.
    jobs.land_current(spark, ext, paths["cur"])
    past, res = jobs.run_monthly(spark, ext, ext, paths["cur"], paths["past"], paths["facts"], on_duplicate="latest")
    assert res.mode == "create"
    cur, res = jobs.run_daily(spark, ext, paths["cur"], paths["past"], paths["facts"], on_duplicate="latest")
    assert res.mode == "incremental"
    facts = merge.FactTable(paths["facts"]).read(spark)
    n = facts.count()
    assert n == facts.select("PLAYER_ID", "GAME_ID", "TEAM_ID").distinct().count()


def test_land_current_reads_only_the_latest_season_folder(spark, tmp_dir):
    from courtline.sources import landed as L

    ext = os.path.join(tmp_dir, "extracts")
    g = _lay_out_extracts(spark, ext)
    latest = g.agg(F.max("SEASON")).first()[0]
    res = jobs.land_current(spark, ext, os.path.join(tmp_dir, "cur"))
    out = spark.read.parquet(res.path)
    assert {r.SEASON for r in out.select("SEASON").distinct().collect()} == {latest}
    assert out.count() == g.where(F.col("SEASON") == latest).count()
    assert {f.split("SEASON=")[1].split("/")[0] for f in L.read_game_logs(spark, ext, seasons=[latest]).inputFiles()} == {latest}


def _two_seasons(spark, root):
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG)
    g.where("SEASON in ('1996', '1997')").write.partitionBy("SEASON", "GAME_TYPE").parquet(root)
    return g.where("SEASON in ('1996', '1997')")


def test_files_of_two_schemas_in_one_folder(spark, tmp_dir):
    """The second file has a column more and other types: nothing is lost, nothing fails."""
    ext = os.path.join(tmp_dir, "ext")
    a = spark.createDataFrame([(1, "0000000001", 10.5)], "PLAYER_ID long, GAME_ID string, PTS double")
    b = spark.createDataFrame([(2, "0000000002", 7, "somebody")], "PLAYER_ID long, GAME_ID string, PTS long, PLAYER_NAME string")
    for df in (a, b):
        df.coalesce(1).write.mode("append").parquet(f"{ext}/SEASON=1993/GAME_TYPE=Playoffs")
    out = landed.read_game_logs(spark, ext)
    assert sorted((r.PLAYER_ID, r.PTS, r.PLAYER_NAME, r.SEASON) for r in out.collect()) == [(1, 10.5, None, "1993"), (2, 7.0, "somebody", "1993")]


def test_schemas_that_agree_are_one_scan(spark, tmp_dir):
    ext = os.path.join(tmp_dir, "ext")
    for i in range(12):
        kind = "long" if i % 2 else "double"
        row = (i, i if i % 2 else float(i))
        spark.createDataFrame([row], f"PLAYER_ID long, PTS {kind}").withColumn(f"C{i % 3}", F.lit(i)).write.parquet(f"{ext}/SEASON={1990 + i}/GAME_TYPE=x")
    out = landed.read_game_logs(spark, ext)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2  # one for each type of PTS
    got = {r.PLAYER_ID: (r.PTS, r.C0, r.C1, r.C2, r.SEASON) for r in out.collect()}
    assert got == {i: (float(i), *(i if i % 3 == k else None for k in range(3)), str(1990 + i)) for i in range(12)}


def test_a_season_that_cannot_be_read_is_left_out_and_reported(spark, tmp_dir):
    ext = os.path.join(tmp_dir, "ext")
    g = _two_seasons(spark, ext)
    broken = f"{ext}/SEASON=1996/GAME_TYPE=Playoffs/part-x.parquet"
    storage.write_text(spark, broken, "no footer")
    storage.write_text(spark, f"{ext}/SEASON=1997/GAME_TYPE=Playoffs/_note.txt", "hidden files are no extracts")
    out = jobs.land_past(spark, ext, os.path.join(tmp_dir, "out"), "2100-01-01")
    kept = g.where("not (SEASON = '1996' and GAME_TYPE = 'Playoffs')").count()
    assert 0 < kept < g.count()
    assert spark.read.parquet(out.path).count() == kept
    (r,) = out.failed.collect()
    assert (r.SEASON, r.FILE) == ("1996", broken) and r.ERROR
    before = spark.read.parquet(out.path).count()
    with pytest.raises(landed.UnreadableExtract, match="part-x"):
        jobs.land_past(spark, ext, out.path, "2100-01-01", on_unreadable="error")
    assert spark.read.parquet(out.path).count() == before  # nothing was written
    with pytest.raises(landed.UnreadableExtract):
        jobs.run_monthly(spark, ext, ext, out.path, os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "f"), "2100-01-01", full_refresh=True)


def test_seasons_that_are_not_listed_are_reported(spark, tmp_dir):
    ext, ty = os.path.join(tmp_dir, "ext"), os.path.join(tmp_dir, "ty")
    g = _two_seasons(spark, ext)
    _lay_out_team_years(spark, ty, g.where("SEASON = '1997'"), extra_seasons=("2050",))
    out = jobs.land_past(spark, ext, os.path.join(tmp_dir, "out"), "2100-01-01", team_totals_root=ty)
    assert [r.SEASON for r in out.skipped.collect()] == ["2050"] and [r.SEASON for r in out.unlisted.collect()] == ["1996"]
    assert {r.SEASON for r in spark.read.parquet(out.path).select("SEASON").distinct().collect()} == {"1997"}


def test_a_second_landing_reads_only_what_changed(spark, tmp_dir):
    ext, out = os.path.join(tmp_dir, "ext"), os.path.join(tmp_dir, "out")
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG).where("SEASON in ('1995', '1996', '1997')")
    g.write.partitionBy("SEASON", "GAME_TYPE").parquet(ext)
    rows = lambda df: sorted(map(repr, df.select("SEASON", "PLAYER_ID", "GAME_ID", "TEAM_ID", "PTS", "GAME_TYPE").collect()))

    def full(cut):
        return rows(spark.read.parquet(jobs.land_past(spark, ext, os.path.join(tmp_dir, "full"), cut).path))

    df, res = jobs.land_past_changes(spark, ext, out, "1997-06-01")
    assert res.landed == ["1995", "1996", "1997"] and rows(df) == full("1997-06-01")
    df, res = jobs.land_past_changes(spark, ext, out, "1997-06-01")
    assert (res.landed, res.kept, res.version) == ([], ["1995", "1996", "1997"], 1)
    # one season more files with a column of their own, one is gone
    more = g.where("SEASON = '1996'").limit(5).withColumn("PTS", F.col("PTS") + 100).withColumn("PLAYER_NAME", F.lit("x"))
    more.write.mode("append").partitionBy("SEASON", "GAME_TYPE").parquet(ext)
    storage.delete(spark, f"{ext}/SEASON=1995")
    df, res = jobs.land_past_changes(spark, ext, out, "1997-06-01")
    assert (res.landed, res.kept, res.dropped) == (["1996"], ["1997"], ["1995"])
    assert rows(df) == full("1997-06-01") and df.where("PLAYER_NAME = 'x'").count() == 5
    # a season that can't be read keeps its landing; a new cutoff lands all the others again
    storage.write_text(spark, f"{ext}/SEASON=1996/GAME_TYPE=Playoffs/part-x.parquet", "no footer")
    before = rows(df.where("SEASON = '1996'"))
    df, res = jobs.land_past_changes(spark, ext, out, "1997-03-01")
    assert (res.landed, res.kept) == (["1997"], ["1996"]) and [v[0] for v, _, _ in res.failed] == ["1996"]
    assert rows(df.where("SEASON = '1996'")) == before
    assert rows(df.where("SEASON = '1997'")) == [r for r in full("1997-03-01") if "SEASON='1997'" in r]


def test_cutoff_from_footers_reads_no_data(spark, tmp_dir, monkeypatch):
    """Date-times as extracts have them; text, where the footers don't tell, is read; nulls don't count."""
    ext = os.path.join(tmp_dir, "ext")
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG)
    latest = g.agg(F.max("SEASON")).first()[0]
    holes = g.withColumn("GAME_DATE", F.when(F.col("PTS") > 5, F.col("GAME_DATE")))
    holes.repartition(3).write.partitionBy("SEASON", "GAME_TYPE").parquet(ext)
    want = split.cutoff_value(holes)
    text = holes.where(F.col("SEASON") == latest).withColumn("GAME_DATE", F.date_format("GAME_DATE", "yyyy-MM-dd'T'HH:mm:ss"))
    text.write.partitionBy("SEASON", "GAME_TYPE").parquet(ext + "-text")
    none = holes.where(F.col("SEASON") == latest).withColumn("GAME_DATE", F.lit(None).cast("timestamp_ntz"))
    none.write.partitionBy("SEASON", "GAME_TYPE").parquet(ext + "-none")
    assert jobs.current_cutoff(spark, ext + "-text") == want

    def read(*args):
        raise AssertionError("data was read")

    monkeypatch.setattr(split, "cutoff_value", read)
    assert jobs.current_cutoff(spark, ext) == want
    with pytest.raises(split.EmptyCutoff):
        jobs.current_cutoff(spark, ext + "-none")
    with pytest.raises(AssertionError, match="data was read"):
        jobs.current_cutoff(spark, ext + "-text")
