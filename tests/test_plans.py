"""Plan properties the design relies on, checked on the physical plans."""

import re

import pytest

from courtline.plans import catalog
from tests.conftest import SF_SMALL


def _plan(spark, name):
    return catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = _plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_cutoff_filter_reaches_parquet(spark):
    plan = _plan(spark, "past_games")
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", plan)
    plan = _plan(spark, "current_games")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)


def test_columns_are_pruned(spark):
    plan = _plan(spark, "top_k")
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert len(schema.split(",")) <= 4


def test_top_k_per_group_limits_before_shuffle(spark):
    assert "WindowGroupLimit" in _plan(spark, "top_k_per_season")
    assert "TakeOrderedAndProject" in _plan(spark, "top_k")


def test_small_dimensions_are_broadcast_at_run_time(spark):
    """No hint: AQE replaces the joins once it has measured the dimensions."""
    df = catalog.QUERIES["facts_named"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and final.count("BroadcastHashJoin") >= 2


def test_rank_window_runs_on_value_histogram(spark):
    plan = _plan(spark, "rank_players")
    # The window's input is an aggregate keyed by (season, type, value).
    assert re.search(r"HashAggregate\(keys=\[SEASON_YEAR#\d+, GAME_TYPE#\d+, PTS#\d+L?\]", plan)


def test_merged_facts_shuffles_the_wide_rows_once(spark):
    """Three unions' scans each join lineitem to orders; only one exchange is on the key."""
    plan = _plan(spark, "merged_facts")
    on_key = re.findall(r"Exchange hashpartitioning\(PLAYER_ID#\d+L?, GAME_ID#\d+L?, TEAM_ID", plan)
    assert len(on_key) == 1
    assert "SortMergeJoin [PLAYER_ID" not in plan and "LeftAnti" not in plan


def test_latest_game_reads_one_date(spark):
    plan = _plan(spark, "latest_game")
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderdate", plan)
