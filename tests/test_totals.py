"""Totals kept up to date by versions, against totals of the whole table."""

import pytest
from pyspark.sql import functions as F

from courtline.operators import conform, merge, reports, totals
from tests.fixtures import frame, game

BY = ["TEAM_ID", "SEASON_YEAR"]


def _typed(spark, rows):
    return conform.conform_games(frame(spark, rows))


def _of(year, game_id, **more):
    return game(game_id=f"{game_id:010d}", date=f"{year}-03-01", season=str(year), **more)


def _same(spark, kept, table):
    got, want = kept.read(spark), reports.totals(table.read(spark), BY)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_three_merges_equal_a_full_recomputation(spark, tmp_dir):
    table, kept = merge.FactTable(f"{tmp_dir}/facts"), totals.TotalsTable(f"{tmp_dir}/totals", BY)
    none = _typed(spark, [])
    runs = [
        [_of(1995, i, team=10 + i % 3, pts=float(i), WL="W" if i % 2 else "L") for i in range(1, 30)] + [_of(1996, 40, REB=None, MIN=None)],
        [_of(1995, 2, team=12, pts=50.0), _of(1997, 41, team=99)],  # a changed row and a new group
        [_of(1996, 41, team=99), _of(1996, 40, REB=7.0)],  # the group moves to another year, a null becomes a value
    ]
    since = [None, 1, 2]
    for n, rows in enumerate(runs):
        table.merge(spark, _typed(spark, rows), none)
        res = kept.refresh(spark, table)
        assert (res.version, res.since) == (n + 1, since[n])
        _same(spark, kept, table)
    assert res.years_read == 2  # 1996 and 1997; 1995 was not touched
    assert kept.read(spark).where("SEASON_YEAR = 1997").isEmpty()
    assert kept.refresh(spark, table).years_read == 0


def test_a_version_that_is_gone_is_summed_anew(spark, tmp_dir):
    table, kept = merge.FactTable(f"{tmp_dir}/facts"), totals.TotalsTable(f"{tmp_dir}/totals", BY)
    none = _typed(spark, [])
    with pytest.raises(ValueError, match="no version"):
        kept.refresh(spark, table)
    table.merge(spark, _typed(spark, [_of(1995, 1)]), none)
    kept.refresh(spark, table)
    for i in (2, 3):
        table.merge(spark, _typed(spark, [_of(1995 + i, i)]), none)
    table.vacuum(spark, keep=1, older_than_hours=0)
    res = kept.refresh(spark, table)
    assert (res.version, res.since, res.years_read) == (3, None, 3)
    _same(spark, kept, table)


def test_difference_of_two_versions(spark, tmp_dir):
    table = merge.FactTable(f"{tmp_dir}/facts")
    none = _typed(spark, [])
    table.merge(spark, _typed(spark, [_of(1995, 1, pts=1.0), _of(1995, 2), _of(1996, 3)]), none)
    table.merge(spark, _typed(spark, [_of(1995, 1, pts=5.0), _of(1997, 4)]), none)
    added, removed = table.difference(spark, 1)
    assert sorted((r.GAME_ID, r.PTS) for r in added.collect()) == [(1, 5), (4, 20)]
    assert [(r.GAME_ID, r.PTS) for r in removed.collect()] == [(1, 1)]
    changes, years = table.changes(spark, 1, 2)
    assert years == {1995, 1997} and changes.agg(F.sum("_SIGN")).first()[0] == 1


def test_a_refresh_adds_the_rows_that_came_in_one_aggregate(spark, tmp_dir):
    table, kept = merge.FactTable(f"{tmp_dir}/facts"), totals.TotalsTable(f"{tmp_dir}/totals", BY)
    none = _typed(spark, [])
    table.merge(spark, none, _typed(spark, [_of(1995, i, team=10 + i % 2) for i in range(1, 8)]))
    kept.refresh(spark, table)
    table.merge(spark, none, _typed(spark, [_of(1995, 3, team=11, pts=99.0), _of(1995, 8, WL=None, AST=None, MIN=None), _of(1996, 9)]))
    changes, _ = table.changes(spark, 1)
    assert sorted(r.GAME_ID for r in changes.collect()) == [8, 9]
    plan = totals.added(kept.sums(spark), totals.shares(changes, BY), BY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    assert kept.refresh(spark, table).years_read == 2
    _same(spark, kept, table)
