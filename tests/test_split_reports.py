import datetime as dt

from pyspark.sql import functions as F

from courtline.operators import reports, split
from tests.fixtures import frame, game


def _games(spark):
    return frame(
        spark,
        [
            game(game_id="0000000001", date="2023-04-01", season="2022-23"),
            game(game_id="0000000002", date="2023-10-24", season="2023-24"),
            game(game_id="0000000003", date="2023-12-01", season="2023-24"),
            game(game_id="0000000004", date=None, season="2023-24"),
        ],
    )


def test_cutoff_is_first_game_of_latest_season(spark):
    g = _games(spark)
    row = split.first_game_date(g).first()
    assert row.CURRENT_SEASON == "2023-24" and row.FIRST_GAME_DATE == dt.date(2023, 10, 24)


def test_cutoff_day_is_current_and_null_date_in_neither(spark):
    g = _games(spark)
    cut = split.cutoff(g)
    cur = {r.GAME_ID for r in split.current_side(g, cut).collect()}
    past = {r.GAME_ID for r in split.past_side(g, cut).collect()}
    assert cur == {"0000000002", "0000000003"}
    assert past == {"0000000001"}


def test_literal_cutoff(spark):
    g = _games(spark)
    assert split.current_side(g, "2023-12-01").count() == 1


def test_running_rows_and_coverage(spark):
    g = _games(spark)
    rr = {r.SEASON: (r.N_ROWS, r.TOTAL_ROWS) for r in reports.running_rows(g).collect()}
    assert rr == {"2022-23": (1, 1), "2023-24": (3, 4)}
    requested = spark.createDataFrame([("2021-22",), ("2022-23",), ("2023-24",)], "SEASON string")
    skipped = [r.SEASON for r in reports.skipped_seasons(requested, g.select("SEASON")).collect()]
    assert skipped == ["2021-22"]


def test_top_k_per_group_and_rank(spark):
    df = spark.createDataFrame(
        [("s1", 1, 10), ("s1", 2, 30), ("s1", 3, 30), ("s1", 4, 5), ("s2", 1, 7)],
        "SEASON_YEAR string, PLAYER_ID long, PTS long",
    )
    top = reports.top_k_per_group(df, ["SEASON_YEAR"], "PTS", 2, "PLAYER_ID")
    assert sorted((r.SEASON_YEAR, r.PLAYER_ID, r.POS) for r in top.collect()) == [
        ("s1", 2, 1), ("s1", 3, 2), ("s2", 1, 1)
    ]
    ranked = {r.PLAYER_ID: (r.PTS_RANK, r.PTS_DENSE_RANK) for r in
              reports.rank_within(df.where("SEASON_YEAR = 's1'"), ["SEASON_YEAR"], "PTS").collect()}
    assert ranked == {2: (1, 1), 3: (1, 1), 1: (3, 2), 4: (4, 3)}


def test_trend_and_compare(spark):
    df = spark.createDataFrame(
        [(1, "2001", 10), (1, "2002", 15), (2, "2002", 4), (3, "2002", 9)],
        "TEAM_ID long, SEASON_YEAR string, PTS long",
    )
    tr = {(r.TEAM_ID, r.SEASON_YEAR): (r.PREV_PTS, r.PTS_CHANGE) for r in reports.trend(df, "TEAM_ID").collect()}
    assert tr[(1, "2002")] == (10, 5) and tr[(1, "2001")] == (None, None)
    cmp = {r.SEASON_YEAR: (r.TEAM_1_PTS, r.TEAM_2_PTS) for r in reports.compare(df, "TEAM_ID", [1, 2]).collect()}
    assert cmp == {"2001": (10, None), "2002": (15, 4)}


def test_latest_game_tie_break(spark):
    g = _games(spark)
    assert reports.latest_game(g).first().GAME_ID == "0000000003"


def test_totals_percentages(spark):
    df = spark.createDataFrame(
        [(1, "W", 3, 6, 0, 0, 1, 2), (1, "L", 1, 4, 0, 0, 1, 2)],
        "PLAYER_ID long, WL string, FGM long, FGA long, FG3M long, FG3A long, FTM long, FTA long",
    )
    for c in reports.SUM_METRICS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(1).cast("long"))
    r = reports.totals(df, ["PLAYER_ID"]).first()
    assert (r.GAMES, r.WINS) == (2, 1)
    assert abs(r.FG_PCT - 0.4) < 1e-12 and r.FG3_PCT is None and r.FT_PCT == 0.5


def test_histogram_rank_equals_window_rank(spark):
    import random

    from pyspark.sql import Window

    rnd = random.Random(7)
    rows = [
        (rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), rnd.randint(1, 400),
         rnd.choice([None] + list(range(8))))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "S string, T string, P long, PTS long")
    got = reports.rank_within(df, ["S", "T"], "PTS")
    w = Window.partitionBy("S", "T").orderBy(F.col("PTS").desc())
    want = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    a = sorted((tuple(r) for r in got.collect()), key=repr)
    b = sorted((tuple(r) for r in want.collect()), key=repr)
    assert a == b


def test_rank_of_ratios_and_of_one_value(spark):
    from pyspark.sql import Window

    df = spark.range(500).selectExpr("id as P", "'s' as S", "cast(id * 7919 % 500 as double) / 499 as PTS")
    one = spark.createDataFrame([(1, "t", 3.0), (2, "t", 3.0), (3, "u", None)], "P long, S string, PTS double")
    df = df.unionByName(one)
    w = Window.partitionBy("S").orderBy(F.col("PTS").desc())
    want = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    got = reports.rank_within(df, ["S"], "PTS")
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))


def test_ranges_have_equal_depth_whatever_the_values(spark):
    """One outlier, ties and exponents: no range holds a twentieth of the distinct values, equal values are together."""
    from pyspark.sql import Window

    one = spark.range(20_000).selectExpr("'a' as S", "cast(id as double) as PTS").unionByName(spark.createDataFrame([("a", 1e18)], "S string, PTS double"))
    steep = spark.range(5_000).selectExpr("'b' as S", "pow(1.1, id) as PTS")
    few = spark.range(5_000).selectExpr("cast(null as string) as S", "cast(id % 7 as double) as PTS")
    df = one.unionByName(steep).unionByName(few).unionByName(spark.createDataFrame([("a", None)], "S string, PTS double"))
    hist = df.groupBy("S", "PTS").count()
    dealt = reports.dealt_by_value(hist, ["S"], "PTS")
    share = dealt.groupBy("S", "_range").count().join(hist.groupBy("S").agg(F.count(F.lit(1)).alias("of")), "S")
    assert share.agg(F.max(F.col("count") / F.col("of"))).first()[0] <= 0.05
    assert dealt.count() == hist.count()
    w = Window.partitionBy("S").orderBy(F.col("PTS").desc())
    want = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert reports.rank_within(df, ["S"], "PTS").exceptAll(want).isEmpty()
    assert want.exceptAll(reports.rank_within(df, ["S"], "PTS")).isEmpty()
