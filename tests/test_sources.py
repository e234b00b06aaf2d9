import json
import os

from pyspark.sql import functions as F

from courtline import schemas, session
from courtline.operators import combine, conform
from courtline.plans import jobs, proxy
from courtline.sources import Registry, landed
from tests.conftest import SF_SMALL
from tests.fixtures import frame, game


def test_external_catalog_tables(spark, tmp_dir):
    path = os.path.join(tmp_dir, "player_games_current")
    frame(spark, [game(game_id="0000000001"), game(game_id="0000000002")]).write.parquet(path)
    reg = Registry.under(spark, tmp_dir, names=["player_games_current"])
    assert reg.create_external_tables("stg_test") == ["stg_test.player_games_current"]
    assert spark.sql("select count(*) from stg_test.player_games_current").first()[0] == 2
    # Re-running is harmless.
    reg.create_external_tables("stg_test")


def test_json_list_landing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "players.json")
    with open(src, "w") as f:
        for i, name in enumerate(["Ann Lee", "Bo Kim"]):
            first, last = name.split()
            f.write(json.dumps({"id": i, "full_name": name, "first_name": first,
                                "last_name": last, "is_active": i == 0}) + "\n")
    dim = jobs.refresh_players(spark, src, os.path.join(tmp_dir, "dim"), fmt="json")
    rows = sorted((r.ID, r.FULL_NAME, r.IS_ACTIVE) for r in dim.collect())
    assert rows == [(0, "Ann Lee", True), (1, "Bo Kim", False)]
    assert dict(dim.dtypes)["ID"] == "bigint"


def test_append_many_by_name(spark):
    frames = [frame(spark, [game(game_id=f"{i:010d}")]) for i in range(4)]
    frames[1] = frames[1].drop("BLKA")
    out = combine.append_all(frames)
    assert out.count() == 4
    assert out.where("BLKA is null").count() == 1


def test_read_game_logs_prunes_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "ext")
    g = conform.enforce_schema(proxy.game_logs(spark, SF_SMALL), schemas.RAW_GAME_LOG)
    g.write.partitionBy("SEASON", "GAME_TYPE").parquet(root)
    df = landed.read_game_logs(spark, root, seasons=["1996"], game_types=["Playoffs"])
    assert df.count() == g.where("SEASON = '1996' and GAME_TYPE = 'Playoffs'").count()
    assert all("SEASON=1996/GAME_TYPE=Playoffs" in f for f in df.inputFiles())


def test_checkpoint_dir_is_read_from_session(spark):
    d = session.checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(d.rstrip("/") + "/courtline-x-")


def test_registry_contract_check(spark, tmp_dir):
    import pytest

    from courtline.operators.conform import SchemaMismatch

    frame(spark, [game()]).drop("GAME_TYPE").write.parquet(os.path.join(tmp_dir, "player_games_past"))
    reg = Registry.under(spark, tmp_dir, names=["player_games_past"])
    assert reg.table("player_games_past").count() == 1
    with pytest.raises(SchemaMismatch) as e:
        reg.table("player_games_past", check=True)
    assert e.value.missing == ["GAME_TYPE"]


def test_files_of_two_writes_in_each_folder_take_few_schema_merges(spark, tmp_dir, monkeypatch):
    rows = frame(spark, [game(player=i, game_id=f"{i:010d}", season=f"{2000 + i % 4}") for i in range(32)]).repartition(4)
    for side in (rows, rows.withColumn("PTS", rows["PTS"].cast("bigint"))):
        side.write.mode("append").partitionBy("SEASON").parquet(f"{tmp_dir}/ext")
    tried, footers = [], landed._footers
    monkeypatch.setattr(landed, "_footers", lambda s, r, files, d: tried.append(len(files)) or footers(s, r, files, d))
    out = landed.read_laid_out(spark, f"{tmp_dir}/ext", ["SEASON"], schemas.without(schemas.RAW_GAME_LOG, "SEASON"))
    assert sorted(r["PLAYER_ID"] for r in out.collect()) == sorted([*range(32)] * 2)
    assert len(tried) == 3 and tried[0] == tried[1] + tried[2]


def test_yearly_totals_of_many_teams_in_one_file(spark, tmp_dir):
    rows = [(t, f"{2000 + t % 3}") for t in range(200)]
    totals = spark.createDataFrame(rows, schemas.TEAM_YEAR_TOTALS).withColumn("TEAM_GROUP", F.lit(1))
    totals.coalesce(1).write.partitionBy("TEAM_GROUP").parquet(f"{tmp_dir}/totals")
    read = landed.read_team_year_totals(spark, f"{tmp_dir}/totals")
    assert read.columns == schemas.TEAM_YEAR_TOTALS.names
    assert sorted(map(tuple, read.collect())) == sorted(rows)
    totals.drop("TEAM_GROUP").where("TEAM_ID < 5").write.partitionBy("TEAM_ID").parquet(f"{tmp_dir}/each")
    assert sorted(map(tuple, landed.read_team_year_totals(spark, f"{tmp_dir}/each").collect())) == sorted(rows[:5])


def _order_tables(spark, root):
    li = [(o, p, 1, n, 5.0 + n, 10.0, 0.1, 0.0, "R") for o in range(6) for p, n in ((1, 1), (2, 2), (2, 2))]
    spark.createDataFrame(
        li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    ).write.parquet(f"{root}/lineitem.parquet")
    orders = spark.createDataFrame([(o, o, "2001-02-03 00:00:00" if o else None, "1-URGENT") for o in range(5)], "o_orderkey long, o_custkey long, d string, o_orderpriority string")
    orders.selectExpr("o_orderkey", "o_custkey", "cast(d as timestamp_ntz) as o_orderdate", "o_orderpriority").write.parquet(f"{root}/orders.parquet")


def test_stored_games_are_the_joined_ones_and_not_joined_again(spark, tmp_dir):
    _order_tables(spark, tmp_dir)
    joined, stored = proxy.game_logs(spark, tmp_dir), proxy.game_logs(spark, tmp_dir, stored=True)
    assert stored.schema == joined.schema
    assert sorted(map(str, stored.collect())) == sorted(map(str, joined.collect()))
    assert "Join" not in stored._jdf.queryExecution().optimizedPlan().toString()
