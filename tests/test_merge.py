import os

import pytest
from pyspark.sql import functions as F

from courtline.operators import conform, merge
from tests.fixtures import frame, game


def _typed(spark, rows):
    return conform.conform_games(frame(spark, rows))


def _rows(df, cols=("PLAYER_ID", "GAME_ID", "TEAM_ID", "PTS", "GAME_DATE")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _table(spark, tmp_dir):
    return merge.FactTable(os.path.join(tmp_dir, "facts"))


def test_first_run_writes_everything_partitioned(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    cur = _typed(spark, [game(game_id="0000000002", date="2024-01-02")])
    past = _typed(spark, [game(game_id="0000000001", date="2023-03-01", season="2022-23")])
    res = t.merge(spark, cur, past)
    assert res.mode == "create" and res.incoming_rows == 2
    assert t.years(spark) == [2023, 2024]
    df = t.read(spark)
    assert df.count() == 2
    assert df.where(F.col("GAME_YEAR") == 2023).count() == 1


def test_run_twice_changes_only_last_update(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    cur = frame(spark, [game(game_id="0000000002", date="2024-01-02")])
    past = frame(spark, [game(game_id="0000000001", date="2023-03-01", season="2022-23")])
    t.merge(spark, conform.conform_games(cur), conform.conform_games(past))
    first = _rows(t.read(spark))
    t.merge(spark, conform.conform_games(cur), conform.conform_games(past))
    second = t.read(spark)
    assert _rows(second) == first
    assert second.count() == second.select("PLAYER_ID", "GAME_ID", "TEAM_ID").distinct().count()


def test_changed_current_row_updated_and_past_row_kept(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    cur = [game(game_id="0000000002", date="2024-01-02", pts=10.0)]
    past = [game(game_id="0000000001", date="2023-03-01", season="2022-23", pts=5.0)]
    t.merge(spark, _typed(spark, cur), _typed(spark, past))
    cur2 = [game(game_id="0000000002", date="2024-01-02", pts=11.0)]
    past2 = [
        game(game_id="0000000001", date="2023-03-01", season="2022-23", pts=99.0),
        game(game_id="0000000003", date="2023-03-02", season="2022-23", pts=7.0),
    ]
    res = t.merge(spark, _typed(spark, cur2), _typed(spark, past2))
    assert res.mode == "incremental"
    got = {r.GAME_ID: r.PTS for r in t.read(spark).collect()}
    assert got == {2: 11, 1: 5, 3: 7}


def test_untouched_years_are_not_rewritten(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    past = [game(game_id="0000000001", date="2020-03-01", season="2019-20")]
    cur = [game(game_id="0000000002", date="2024-01-02")]
    t.merge(spark, _typed(spark, cur), _typed(spark, past))
    old = t.manifest(spark)
    res = t.merge(spark, _typed(spark, [game(game_id="0000000002", date="2024-01-02", pts=3.0)]), _typed(spark, past))
    assert res.years_written == [2024]
    new = t.manifest(spark)
    assert new[2020] == old[2020] and new[2024] != old[2024]


def test_moved_year_leaves_one_row_and_drops_empty_year(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    past = [game(game_id="0000000001", date="2022-01-01", season="2021-22")]
    t.merge(spark, _typed(spark, [game(game_id="0000000009", date="2023-12-31")]), _typed(spark, past))
    assert t.years(spark) == [2022, 2023]
    res = t.merge(spark, _typed(spark, [game(game_id="0000000009", date="2024-01-01")]), _typed(spark, past))
    assert res.years_dropped == [2023]
    assert t.years(spark) == [2022, 2024]
    rows = t.read(spark).where(F.col("GAME_ID") == 9).collect()
    assert len(rows) == 1 and str(rows[0].GAME_DATE) == "2024-01-01"


def test_ambiguous_concatenated_key_stays_two_rows(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    # Parts (1, "23") and (12, "3") concatenate to the same ID "1234".
    a = game(player=1, game_id="23", team=4, date="2024-01-02", pts=1.0)
    b = game(player=12, game_id="3", team=4, date="2024-01-02", pts=2.0)
    assert {r.ID for r in _typed(spark, [a, b]).collect()} == {"1234"}
    t.merge(spark, _typed(spark, [a]), _typed(spark, [b]))
    t.merge(spark, _typed(spark, [a]), _typed(spark, [b]))
    got = sorted((r.PLAYER_ID, r.GAME_ID, r.PTS) for r in t.read(spark).collect())
    assert got == [(1, 23, 1), (12, 3, 2)]


def test_null_key_rejected_with_report(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    with pytest.raises(merge.NullKeyError) as e:
        t.merge(spark, _typed(spark, [game(player=None)]), _typed(spark, [game(game_id="0000000003")]))
    assert e.value.rows == 1
    assert e.value.rejects.count() == 1
    assert not t.exists(spark)


def test_duplicate_key_error_or_latest(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    dup = [game(date="2024-01-02", pts=1.0), game(date="2024-01-03", pts=2.0)]
    with pytest.raises(merge.DuplicateKeyError):
        t.merge(spark, _typed(spark, dup), _typed(spark, []))
    res = t.merge(spark, _typed(spark, dup), _typed(spark, []), on_duplicate="latest")
    assert res.incoming_rows == 1
    (r,) = t.read(spark).collect()
    assert r.PTS == 2


def test_full_refresh_equals_incremental_when_past_unchanged(spark, tmp_dir):
    inc = merge.FactTable(os.path.join(tmp_dir, "inc"))
    full = merge.FactTable(os.path.join(tmp_dir, "full"))
    past = [game(game_id=f"{i:010d}", date="2023-03-01", season="2022-23") for i in range(5)]
    cur1 = [game(game_id="0000000100", date="2024-01-02", pts=1.0)]
    cur2 = [game(game_id="0000000100", date="2024-01-02", pts=9.0),
            game(game_id="0000000101", date="2024-01-03", pts=4.0)]
    inc.merge(spark, _typed(spark, cur1), _typed(spark, past))
    inc.merge(spark, _typed(spark, cur2), _typed(spark, past))
    full.merge(spark, _typed(spark, cur1), _typed(spark, past))
    full.merge(spark, _typed(spark, cur2), _typed(spark, past), full_refresh=True)
    assert _rows(inc.read(spark)) == _rows(full.read(spark))


def test_sample_is_read_side(spark):
    rows = _typed(spark, [game(game_id=f"{i:010d}") for i in range(10)])
    assert merge.sample_limit(rows, 4).count() == 4 and merge.sample_limit(rows, None).count() == 10


def test_between_dates_prunes_years(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    past = [game(game_id="0000000001", date="2020-03-01", season="2019-20"),
            game(game_id="0000000002", date="2023-03-01", season="2022-23")]
    t.merge(spark, _typed(spark, [game(game_id="0000000100")]), _typed(spark, past))
    df = t.between_dates(spark, "2023-01-01", "2023-12-31")
    assert [r.GAME_ID for r in df.collect()] == [2]
    assert all("GAME_YEAR=2023" in f for f in df.inputFiles())


def test_failed_merge_leaves_table_unchanged(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    past = [game(game_id="0000000001", date="2023-03-01", season="2022-23", pts=5.0)]
    t.merge(spark, _typed(spark, [game(game_id="0000000002", date="2024-01-02", pts=1.0)]), _typed(spark, past))
    before = _rows(t.read(spark))
    dup = [game(game_id="0000000002", date="2024-01-02", pts=8.0), game(game_id="0000000002", date="2024-01-03", pts=9.0)]
    with pytest.raises(merge.DuplicateKeyError):
        t.merge(spark, _typed(spark, dup), _typed(spark, past))
    assert _rows(t.read(spark)) == before


def test_keep_latest_with_a_hot_duplicated_key(spark):
    hot = [game(date=f"2024-01-{1 + i % 28:02d}", pts=float(i)) for i in range(60)]
    other = [game(game_id=f"{i:010d}", date="2024-01-02") for i in range(100, 220)]
    df = _typed(spark, hot + other)
    out = merge.keep_latest(df, order=("GAME_DATE", "PTS"))
    assert out.count() == 121
    (r,) = out.where(F.col("GAME_ID") == 22300001).collect()
    assert str(r.GAME_DATE) == "2024-01-28" and r.PTS == 55


def test_rows_without_a_date_keep_their_own_folder(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    cur = _typed(spark, [game(game_id="0000000002", date="2024-01-02"), game(game_id="0000000005", date=None)])
    t.merge(spark, cur, _typed(spark, []))
    assert t.years(spark) == [2024, None]
    res = t.merge(spark, _typed(spark, [game(game_id="0000000005", date="2024-02-01")]), _typed(spark, []))
    assert res.years_dropped == [None]
    assert t.years(spark) == [2024]
    assert t.read(spark).count() == 2


def test_a_failed_write_leaves_the_old_table_whole(spark, tmp_dir, monkeypatch):
    """Whether the data write or the commit fails, readers keep the old version and a second run succeeds."""
    t = _table(spark, tmp_dir)
    past = [game(game_id="0000000001", date="2023-03-01", season="2022-23", pts=5.0)]
    t.merge(spark, _typed(spark, [game(game_id="0000000002", date="2024-01-02", pts=1.0)]), _typed(spark, past))
    held = t.read(spark)
    before = _rows(held)
    new = [game(game_id="0000000002", date="2024-01-02", pts=8.0)]

    def fail(*args, **kwargs):
        raise OSError("lost")

    for place, name in ((merge.storage, "write_text"), (merge, "_years_at")):
        with monkeypatch.context() as m:
            m.setattr(place, name, fail)
            with pytest.raises(OSError):
                t.merge(spark, _typed(spark, new), _typed(spark, past))
        assert _rows(t.read(spark)) == before
    t.merge(spark, _typed(spark, new), _typed(spark, past))
    assert _rows(held) == before  # a reader of the old version isn't disturbed
    assert {r.PTS for r in t.read(spark).collect()} == {5, 8}
    t.merge(spark, _typed(spark, new), _typed(spark, past))
    assert t.vacuum(spark, keep=1) == []  # young folders may be a run's that hasn't committed
    assert t.vacuum(spark, keep=1, older_than_hours=0)
    assert {r.PTS for r in t.read(spark).collect()} == {5, 8}


def test_a_lost_race_is_reported(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    monkeypatch.setattr(merge.storage, "write_text", lambda *a: False)
    with pytest.raises(merge.ConcurrentRuns, match="other runs"):
        t.merge(spark, _typed(spark, [game()]), _typed(spark, []), attempts=2)


def _while_writing(monkeypatch, t, other):
    """``other`` runs once, when the next merge has read the table and is about to write."""
    write = merge.FactTable._write
    waiting = [other]

    def run(self, *args):
        if waiting:
            waiting.pop()()
        return write(self, *args)

    monkeypatch.setattr(merge.FactTable, "_write", run)


def _of(year, game_id, pts=1.0, **more):
    return game(game_id=f"{game_id:010d}", date=f"{year}-03-01", pts=pts, **more)


def test_overlapping_merges_of_other_years_both_stay(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    t.merge(spark, _typed(spark, [_of(1995, 1)]), none)
    _while_writing(monkeypatch, t, lambda: t.merge(spark, _typed(spark, [_of(1997, 3)]), none))
    res = t.merge(spark, _typed(spark, [_of(1996, 2)]), none)
    assert (res.conflicts, res.version) == (1, 3)
    assert t.years(spark) == [1995, 1996, 1997] and t.read(spark).count() == 3
    assert sorted(r.GAME_ID for r in t.keys(spark)[0].collect()) == [1, 2, 3]


@pytest.mark.parametrize("years", [(1996, 1996), (1996, 1997), (1995, 1996)])
def test_overlapping_merges_that_meet_are_made_anew(spark, tmp_dir, monkeypatch, years):
    """The other run writes the same key (in some year) or the same year: the outcome is that of one run after the other."""
    mine, others = years
    none = _typed(spark, [])
    other, own = [_of(others, 2, pts=5.0)], [_of(mine, 2, pts=7.0), _of(mine, 3)]
    t = _table(spark, tmp_dir)
    t.merge(spark, _typed(spark, [_of(1995, 1), _of(1998, 8)]), none)
    _while_writing(monkeypatch, t, lambda: t.merge(spark, _typed(spark, other), none))
    assert t.merge(spark, _typed(spark, own), none).conflicts == 1
    got = sorted((r.GAME_ID, r.GAME_YEAR, r.PTS) for r in t.read(spark).collect())
    assert got == [(1, 1995, 1), (2, mine, 7), (3, mine, 1), (8, 1998, 1)]
    assert sorted(r.GAME_ID for r in t.keys(spark)[0].collect()) == [1, 2, 3, 8]


def test_overlapping_first_runs_and_past_rows(spark, tmp_dir, monkeypatch):
    """Two creations, and a past row that the other run inserted meanwhile: it stays as inserted."""
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    _while_writing(monkeypatch, t, lambda: t.merge(spark, none, _typed(spark, [_of(1995, 1, pts=5.0)])))
    assert t.merge(spark, _typed(spark, [_of(1996, 2)]), _typed(spark, [_of(1995, 1, pts=9.0)])).conflicts == 1
    assert sorted((r.GAME_ID, r.PTS) for r in t.read(spark).collect()) == [(1, 5), (2, 1)]


def test_a_full_refresh_comes_after_what_it_meets(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    t.merge(spark, _typed(spark, [_of(1995, 1)]), none)
    _while_writing(monkeypatch, t, lambda: t.merge(spark, _typed(spark, [_of(1997, 3)]), none))
    res = t.merge(spark, _typed(spark, [_of(1996, 2)]), none, full_refresh=True)
    assert t.years(spark) == [1996] and res.years_dropped == [1995, 1997] and res.version == 3


def test_a_vacuumed_version_is_not_committed_again(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    t.merge(spark, _typed(spark, [_of(1995, 1)]), none)

    def others():
        for i in (2, 3, 4):
            t.merge(spark, _typed(spark, [_of(2000 + i, i)]), none)
        t.vacuum(spark, keep=1, older_than_hours=0)

    _while_writing(monkeypatch, t, others)
    t.merge(spark, _typed(spark, [_of(1996, 5)]), none)
    assert t.years(spark) == [1995, 1996, 2002, 2003, 2004]


def test_target_keys_are_joined_where_they_lie(spark, tmp_dir):
    """The bucketed key table, of several runs, null years and moved games, and its join without an exchange above it."""
    t = merge.FactTable(f"{tmp_dir}/facts")
    t.merge(spark, _typed(spark, [_of(1995 + i % 3, i) for i in range(1, 40)] + [game(game_id="0000000077", date=None)]), _typed(spark, []))
    t.merge(spark, _typed(spark, [_of(2001, 5), _of(1996, 50), game(game_id="0000000078", date=None)]), _typed(spark, [_of(1990, 60)]))
    rows = sorted((r.GAME_ID, r.GAME_YEAR) for r in t.read(spark).collect() if r.GAME_YEAR)
    keys, name = t.keys(spark)
    assert sorted((r.GAME_ID, r.GAME_YEAR) for r in keys.collect() if r.GAME_YEAR) == rows
    assert sorted(r.GAME_ID for r in keys.where("GAME_YEAR IS NULL").collect()) == [77, 78]
    asked = _typed(spark, [_of(1995, i) for i in range(30, 70)]).select(*merge.KEYS).distinct()
    joined = keys.join(asked.hint("merge"), merge.KEYS, "left_semi")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "Bucketed: true" in line]
    assert scan and "SortMergeJoin" in plan
    left = plan[plan.index("SortMergeJoin") : plan.index("Bucketed: true")]
    assert "Exchange" not in left  # between the join and the target's scan
    assert sorted(r.GAME_ID for r in joined.collect()) == [*range(30, 40), 50, 60]
    spark.sql(f"DROP TABLE {name}")
    assert t.read(spark).count() == 43


def test_merge_plan_keeps_rows_as_the_rules_say(spark):
    tgt = _typed(spark, [game(game_id="0000000001", pts=1.0), game(game_id="0000000002", pts=1.0), game(game_id="0000000009", pts=1.0)])
    cur = _typed(spark, [game(game_id="0000000002", pts=2.0), game(game_id="0000000003", pts=2.0), game(player=None, pts=2.0)])
    past = _typed(spark, [game(game_id="0000000001", pts=3.0), game(game_id="0000000004", pts=3.0), game(player=None, pts=3.0)])
    got = sorted((r.PLAYER_ID is None, r.GAME_ID, r.PTS) for r in merge.merge_plan(tgt, cur, past).collect())
    assert got == [(False, 1, 1), (False, 2, 2), (False, 3, 2), (False, 4, 3), (False, 9, 1), (True, 22300001, 2), (True, 22300001, 3)]


def test_new_keys_narrow_and_wide_agree(spark):
    src = _typed(spark, [game(game_id=f"{i:010d}") for i in range(6)] + [game(player=None, game_id="0000000099")])
    tgt = _typed(spark, [game(game_id=f"{i:010d}") for i in range(0, 6, 2)])
    a = sorted(repr(tuple(r)) for r in merge.new_keys(src, tgt).drop("LAST_UPDATE").collect())
    b = sorted(repr(tuple(r)) for r in merge.new_keys(src, tgt, narrow=False).drop("LAST_UPDATE").collect())
    assert a == b and len(a) == 4


def test_a_year_that_only_gets_rows_is_not_rewritten(spark, tmp_dir, monkeypatch):
    """Added rows lie in a further folder, beside those of the year, up to a number of folders; a replaced row has its year rewritten."""
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    t.merge(spark, none, _typed(spark, [_of(1995, i) for i in range(1, 6)] + [_of(1996, 9)]))
    first = t.manifest(spark)
    res = t.merge(spark, none, _typed(spark, [_of(1995, 3, pts=9.0), _of(1995, 6)]))  # one known key, one new
    grown = t.manifest(spark)
    assert res.years_written == [1995] and res.incoming_rows == 1
    assert len(grown[1995]) == 2 and grown[1995][0] == first[1995][0] and grown[1996] == first[1996]
    changes, years = t.changes(spark, 1, 2)
    assert years == {1995} and [(r.GAME_ID, r["_SIGN"]) for r in changes.collect()] == [(6, 1)]  # the year's other rows are not read
    assert sorted((r.GAME_ID, r.PTS) for r in t.read(spark).collect()) == [(i, 1) for i in range(1, 7)] + [(9, 1)]
    assert sorted((r.GAME_ID, r.GAME_YEAR) for r in t.keys(spark)[0].collect()) == [(i, 1995) for i in range(1, 7)] + [(9, 1996)]
    monkeypatch.setattr(merge, "MAX_FOLDERS", 2)
    t.merge(spark, none, _typed(spark, [_of(1995, 7)]))
    assert len(t.manifest(spark)[1995]) == 1 and t.manifest(spark)[1995][0] not in grown[1995]
    t.merge(spark, _typed(spark, [_of(1995, 2, pts=4.0), _of(1996, 10)]), none)
    assert [len(f) for f in t.manifest(spark).values()] == [1, 2]
    assert sorted((r.GAME_ID, r.PTS) for r in t.read(spark).collect()) == sorted([(i, 4 if i == 2 else 1) for i in range(1, 8)] + [(9, 1), (10, 1)])
    t.vacuum(spark, keep=1, older_than_hours=0)
    assert t.read(spark).count() == 9 and len(t.files_for(spark, {"TEAM_ID": [10]})) >= 3


def test_overlapping_runs_add_to_one_year(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    none = _typed(spark, [])
    t.merge(spark, none, _typed(spark, [_of(1995, 1)]))
    _while_writing(monkeypatch, t, lambda: t.merge(spark, none, _typed(spark, [_of(1995, 2, pts=5.0), _of(1995, 3)])))
    assert t.merge(spark, none, _typed(spark, [_of(1995, 2, pts=7.0), _of(1995, 4)])).conflicts == 1
    assert sorted((r.GAME_ID, r.PTS) for r in t.read(spark).collect()) == [(1, 1), (2, 5), (3, 1), (4, 1)]


def test_manifests_of_one_folder_a_year_are_read(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.merge(spark, _typed(spark, [_of(1995, 1), _of(1996, 2)]), _typed(spark, []))
    former = [{"year": e["year"], "folder": e["folders"][0], "keys": e["keys"][0], "buckets": e["buckets"]} for e in t._entries(spark, 1)]
    assert merge.storage.write_text(spark, f"{t.manifests}/2.json", merge.json.dumps(former))
    t.merge(spark, _typed(spark, [_of(1996, 2, pts=3.0)]), _typed(spark, [_of(1995, 3)]))
    assert sorted((r.GAME_ID, r.PTS) for r in t.read(spark).collect()) == [(1, 1), (2, 3), (3, 1)]
    assert t.read(spark, 2).count() == 2


def test_files_are_skipped_by_team_and_by_player(spark, tmp_dir):
    """A file of the table holds few teams and few players: either filter reads under two fifths of the files."""
    off = "spark.sql.adaptive.coalescePartitions.enabled"
    before, parts = spark.conf.get(off), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(off, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = [game(game_id=f"{i:010d}", team=100 + i * 7919 % 60, player=i * 104729 % 997, date="2024-03-01") for i in range(6000)]
        t = merge.FactTable(f"{tmp_dir}/facts", buckets=8)
        t.merge(spark, _typed(spark, rows), _typed(spark, []))
    finally:
        spark.conf.set(off, before)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    t.merge(spark, _typed(spark, [game(game_id="0000009999", team=100, player=-5, date="2023-03-01")]), _typed(spark, []))
    files = len(t.files_for(spark, {}))
    assert files > 40
    all_ = _rows(t.read(spark), ("TEAM_ID", "PLAYER_ID", "GAME_ID"))
    for team in (100, 131, 159):
        assert len(t.files_for(spark, {"TEAM_ID": [team]})) <= 0.4 * files
        got = _rows(t.read_for(spark, teams=[team]), ("TEAM_ID", "PLAYER_ID", "GAME_ID"))
        assert got == [r for r in all_ if r[0] == team]
    for player in (0, 500, 996):
        assert len(t.files_for(spark, {"PLAYER_ID": [player]})) <= 0.4 * files
        assert _rows(t.read_for(spark, players=[player]), ("TEAM_ID", "PLAYER_ID", "GAME_ID")) == [r for r in all_ if r[1] == player]
    assert len(t.files_for(spark, {"TEAM_ID": [110], "PLAYER_ID": [300]})) <= 0.15 * files
    assert t.read_for(spark, teams=[100], players=[-5]).count() == 1 and t.read_for(spark, teams=[-1]).count() == 0


def test_only_rows_of_repeated_keys_are_reduced(spark):
    rows = [game(player=i, game_id="0000000001") for i in range(4)] + [game(player=2, game_id="0000000001", pts=31.0)]
    df = _typed(spark, rows).drop("LAST_UPDATE")
    held = []
    out, rep = merge.validate_keys(df, on_duplicate="latest", hold=lambda again: held.append(again) or again)
    assert rep["dup_rows"] == 1 and [r["PLAYER_ID"] for r in held[0].collect()] == [2]
    assert _rows(out) == _rows(merge.keep_latest(df)) and out.columns == df.columns


def test_years_without_a_replaced_key_are_not_joined(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    old = [game(player=1, game_id="0000000001", date="2022-03-01"), game(player=2, game_id="0000000002", date="2023-03-01")]
    t.merge(spark, _typed(spark, []), _typed(spark, old))
    entries = {e["year"]: e for e in t._entries(spark, 1)}
    gone = spark.createDataFrame([(2, 2, 10)], merge._KEY_SCHEMA).select(*merge.KEYS)
    keys = t.read(spark).where("PLAYER_ID = 2").select(*merge.KEYS)
    assert "Join" not in t._kept(spark, entries, {2022, 2023}, set(), gone)._jdf.queryExecution().optimizedPlan().toString()
    assert [r["PLAYER_ID"] for r in t._kept(spark, entries, {2022, 2023}, {2023}, keys).collect()] == [1]
    # rows are added to a year that keeps all of its own, another year's row is replaced
    t.merge(spark, _typed(spark, [game(player=2, game_id="0000000002", date="2023-03-01", pts=9.0)]), _typed(spark, [game(player=5, game_id="0000000005", date="2022-04-01")]))
    assert [(r[0], r[3]) for r in _rows(t.read(spark))] == [(1, 20), (2, 9), (5, 20)]


def test_places_on_the_curve_count_the_cuts_up_to_a_value(spark):
    cuts = [1, 3, 3, 8]
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 2, 3, 7, 8, 9)], "v bigint")
    got = [r[0] for r in df.select(merge._by_rank(cuts, F.col("v"), [10, 11, 12, 13, 14])).collect()]
    assert got == [10, 10, 11, 11, 13, 13, 14, 14]


def test_shuffle_files_go_with_their_query(spark, tmp_dir):
    """A merge leaves no shuffle files on the executors' disks, and the session's settings as they were."""
    import glob
    import time

    from courtline import session

    def files():
        return set(glob.glob(f"{spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().getConf())}/blockmgr-*/*/shuffle_*.data"))

    keys = list(session._FOR_WRITES)
    before = files()
    t = _table(spark, tmp_dir)
    for pts in (1.0, 2.0):
        t.merge(spark, _typed(spark, [_of(1995 + i % 3, i, pts=pts) for i in range(50)]), _typed(spark, []))
    for _ in range(100):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and [spark.conf.get(k, None) for k in keys] == [None, None]
    spark.conf.set(keys[0], "false")
    try:
        with session.for_writes(spark):
            assert [spark.conf.get(k) for k in keys] == ["false", "8000"]
        assert [spark.conf.get(k, None) for k in keys] == ["false", None]
    finally:
        spark.conf.unset(keys[0])
