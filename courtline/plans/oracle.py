"""DuckDB SQL oracles for the registered queries (views of the driver's tables).

DuckDB differs from Spark in a few places that the SQL spells out: ``cast``
of a double to an integer rounds half to even there, so integer casts go
through ``round`` (half away from zero in both); ``sum`` of integers is
HUGEINT and ``year`` BIGINT, so both are cast; ``concat`` skips nulls, so the
key uses ``||``.
"""

from __future__ import annotations

from courtline.plans import proxy

# The columns of a raw game log and of the fact table, written out
# here so that a column lost by a plan isn't lost on both sides.
STATS = (
    "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
    "FT_PCT", "OREB", "DREB", "REB", "AST", "TOV", "STL", "BLK", "BLKA", "PF",
    "PFD", "PTS", "PLUS_MINUS",
)
DECIMALS = ("MIN", "FG_PCT", "FG3_PCT", "FT_PCT")
FILLED = ("FTA", "REB", "AST", "PF")
RAW = ("PLAYER_ID", "TEAM_ID", "GAME_ID", "GAME_DATE", "WL", *STATS, "GAME_TYPE", "SEASON")
SUMMED = (
    "MIN", "PTS", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB",
    "REB", "AST", "STL", "BLK", "TOV", "PF",
)
# Every column of the fact table but the keys and the date, by which the latest of equal keys is told.
REST = ("WL", *STATS, "ID", "GAME_TYPE", "SEASON_YEAR")


def _int(c: str) -> str:
    return f"cast(round({c}) as bigint)"


def _typed_cols() -> str:
    cols = [
        "cast(PLAYER_ID as bigint) as PLAYER_ID",
        "cast(TEAM_ID as bigint) as TEAM_ID",
        "cast(GAME_ID as bigint) as GAME_ID",
        "cast(GAME_DATE as date) as GAME_DATE",
        "cast(WL as varchar) as WL",
    ]
    for c in STATS:
        if c in DECIMALS:
            cols.append(f"cast({c} as decimal(38,9)) as {c}")
        else:
            cols.append(f"{_int(c)} as {c}")
    cols += [
        "cast(PLAYER_ID as varchar) || cast(GAME_ID as varchar) || cast(TEAM_ID as varchar) as ID",
        "cast(GAME_TYPE as varchar) as GAME_TYPE",
        "cast(SEASON as varchar) as SEASON_YEAR",
    ]
    return ", ".join(cols)


def _landed_cols(fill_all: bool = False, drop=()) -> str:
    """Landing shape: FTA, REB, AST, PF filled with 0 then integers."""
    out = []
    for c in RAW:
        if c in drop:
            continue
        if c in FILLED:
            out.append(f"{_int(f'coalesce({c}, 0)')} as {c}")
        elif fill_all and c in STATS + ("PLAYER_ID", "TEAM_ID"):
            out.append(f"coalesce({c}, 0) as {c}")
        else:
            out.append(c)
    return ", ".join(out)


_KEY_MATCH = "t.PLAYER_ID = s.PLAYER_ID and t.GAME_ID = s.GAME_ID and t.TEAM_ID = s.TEAM_ID"

PRELUDE = f"""
with games as materialized ({proxy.GAME_LOG_SQL}),
cut as (
  select min(cast(GAME_DATE as date)) as d from games
  where SEASON = (select max(SEASON) from games)
),
cur_raw as (select * from games where cast(GAME_DATE as date) >= (select d from cut)),
past_raw as (select * from games where cast(GAME_DATE as date) < (select d from cut)),
cur as (select {_typed_cols()} from cur_raw),
past as (select {_typed_cols()} from past_raw),
typed as (select * from cur union all select * from past),
facts as (select {_typed_cols()} from games where GAME_DATE is not null),
target as (select * replace (PTS + 1 as PTS) from typed where GAME_ID % 2 = 0),
past_new as (select * from past s where not exists (select 1 from target t where {_KEY_MATCH})),
incoming as (select * from cur union all select * from past_new),
dim_players as (
  select cast(id as bigint) as ID, cast(full_name as varchar) as FULL_NAME,
         cast(first_name as varchar) as FIRST_NAME, cast(last_name as varchar) as LAST_NAME,
         cast(is_active as boolean) as IS_ACTIVE
  from ({proxy.PLAYERS_SQL})
),
dim_teams as (
  select cast(id as bigint) as ID, cast(full_name as varchar) as FULL_NAME,
         cast(abbreviation as varchar) as ABBREVIATION, cast(nickname as varchar) as NICKNAME,
         cast(city as varchar) as CITY, cast(state as varchar) as STATE,
         cast(year_founded as bigint) as YEAR_FOUNDED
  from ({proxy.TEAMS_SQL})
),
found_seasons as (
  select distinct cast(SEASON as varchar) as SEASON from games where SEASON is not null
),
season_rows as (select SEASON, count(*) as N_ROWS from games group by SEASON),
player_season as (
  select PLAYER_ID, SEASON_YEAR, GAME_TYPE, cast(sum(PTS) as bigint) as PTS
  from facts group by PLAYER_ID, SEASON_YEAR, GAME_TYPE
)
"""


def _totals_sql(by: list[str], source: str = "facts") -> str:
    keys = ", ".join(by)
    aggs = ["count(*) as GAMES", "count(case when WL = 'W' then 1 end) as WINS"]
    for m in SUMMED:
        if m in DECIMALS:
            aggs.append(f"sum({m}) as {m}")
        else:
            aggs.append(f"cast(sum({m}) as bigint) as {m}")
    aggs += ["avg(PTS) as PTS_PER_GAME", "avg(REB) as REB_PER_GAME", "avg(AST) as AST_PER_GAME"]
    ratio = "cast({a} as double) / nullif(cast({b} as double), 0) as {n}"
    return (
        f"select *, {ratio.format(a='FGM', b='FGA', n='FG_PCT')}, "
        f"{ratio.format(a='FG3M', b='FG3A', n='FG3_PCT')}, "
        f"{ratio.format(a='FTM', b='FTA', n='FT_PCT')} "
        f"from (select {keys}, {', '.join(aggs)} from {source} group by {keys})"
    )


_ORDER_LATEST = "order by GAME_DATE desc nulls last, GAME_ID, PLAYER_ID, TEAM_ID limit 1"
_TEAMS = proxy.COMPARED_TEAMS
_FIRST, _LAST = proxy.REQUESTED_SEASONS

BODIES = {
    "current_games": "select * from cur",
    "past_games": "select * from past",
    "first_game_date": (
        "select SEASON as CURRENT_SEASON, min(cast(GAME_DATE as date)) as FIRST_GAME_DATE "
        "from games where SEASON = (select max(SEASON) from games) group by SEASON"
    ),
    "typed_union": "select * from typed",
    "latest_game": (
        f"select * from (select {_landed_cols(fill_all=True)} from past_raw "
        f"union all select {_landed_cols(fill_all=True)} from cur_raw) {_ORDER_LATEST}"
    ),
    "dim_players": "select * from dim_players",
    "dim_teams": "select * from dim_teams",
    "seasons": "select SEASON from found_seasons order by SEASON",
    "union_by_name": (
        f"select {_landed_cols(drop=('GAME_TYPE',))}, cast(null as varchar) as GAME_TYPE from past_raw "
        f"union all select {_landed_cols(drop=('GAME_TYPE',))}, GAME_TYPE from cur_raw"
    ),
    "filled_stats": (
        "select PLAYER_ID, GAME_ID, TEAM_ID, "
        + ", ".join(f"{_int(f'case when {c} in (1, 2) then 0 else coalesce({c}, 0) end')} as {c}" for c in FILLED)
        + ", PTS from games"
    ),
    "filled_all": (
        "select PLAYER_ID, GAME_ID, TEAM_ID, GAME_DATE, "
        "case when FGM in (1, 2) then 0 else FGM end as FGM, case when STL in (1, 2) then 0 else STL end as STL, "
        "nullif(WL, 'W') as WL from games"
    ),
    "skipped_seasons": (
        f"select cast(s as varchar) as SEASON from range({_FIRST}, {_LAST + 1}) r(s) "
        "where cast(s as varchar) not in (select SEASON from found_seasons)"
    ),
    "new_past_keys": "select * from past_new",
    # Closed form: current rows are fresh, past rows that the target has (even games) keep its points.
    "merged_facts": (
        "select * from cur union all "
        "select * replace (case when GAME_ID % 2 = 0 then PTS + 1 else PTS end as PTS) from past"
    ),
    "sample_run": "select * from typed order by ID, PLAYER_ID, GAME_ID, TEAM_ID limit 500",
    "rows_per_season": "select SEASON, N_ROWS from season_rows",
    "running_rows": (
        "select SEASON, N_ROWS, cast(sum(N_ROWS) over (order by SEASON rows between "
        "unbounded preceding and current row) as bigint) as TOTAL_ROWS from season_rows"
    ),
    "facts_named": (
        "select f.PLAYER_ID, f.GAME_ID, f.TEAM_ID, f.GAME_DATE, f.SEASON_YEAR, f.GAME_TYPE, f.PTS, "
        "p.FULL_NAME as PLAYER_NAME, t.FULL_NAME as TEAM_NAME, t.ABBREVIATION as TEAM_ABBREVIATION "
        "from facts f left join dim_players p on f.PLAYER_ID = p.ID "
        "left join dim_teams t on f.TEAM_ID = t.ID"
    ),
    "totals_by_player": _totals_sql(["PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"]),
    "totals_by_team": _totals_sql(["TEAM_ID", "SEASON_YEAR", "GAME_TYPE"]),
    "totals_by_season_type": _totals_sql(["SEASON_YEAR", "GAME_TYPE"]),
    "compare_teams": (
        "select SEASON_YEAR, "
        + ", ".join(f"cast(sum(case when TEAM_ID = {t} then PTS end) as bigint) as TEAM_{t}_PTS" for t in _TEAMS)
        + f" from facts where TEAM_ID in ({', '.join(str(t) for t in _TEAMS)}) group by SEASON_YEAR"
    ),
    "rank_players": (
        "select *, cast(rank() over w as bigint) as PTS_RANK, "
        "cast(dense_rank() over w as bigint) as PTS_DENSE_RANK from player_season "
        "window w as (partition by SEASON_YEAR, GAME_TYPE order by PTS desc)"
    ),
    "rank_teams": (
        "select *, cast(rank() over w as bigint) as PTS_RANK, "
        "cast(dense_rank() over w as bigint) as PTS_DENSE_RANK from ("
        "select TEAM_ID, SEASON_YEAR, GAME_TYPE, cast(sum(PTS) as bigint) as PTS "
        "from facts group by TEAM_ID, SEASON_YEAR, GAME_TYPE) "
        "window w as (partition by SEASON_YEAR, GAME_TYPE order by PTS desc)"
    ),
    "trend_player": (
        "select PLAYER_ID, SEASON_YEAR, GAMES, PTS, lag(PTS) over w as PREV_PTS, "
        "PTS - lag(PTS) over w as PTS_CHANGE from ("
        "select PLAYER_ID, SEASON_YEAR, count(*) as GAMES, cast(sum(PTS) as bigint) as PTS "
        "from facts group by PLAYER_ID, SEASON_YEAR) "
        "window w as (partition by PLAYER_ID order by SEASON_YEAR)"
    ),
    "trend_team": (
        "select TEAM_ID, SEASON_YEAR, GAMES, PTS, lag(PTS) over w as PREV_PTS, "
        "PTS - lag(PTS) over w as PTS_CHANGE from ("
        "select TEAM_ID, SEASON_YEAR, count(*) as GAMES, cast(sum(PTS) as bigint) as PTS "
        "from facts group by TEAM_ID, SEASON_YEAR) "
        "window w as (partition by TEAM_ID order by SEASON_YEAR)"
    ),
    "top_k": (
        "select PLAYER_ID, cast(sum(PTS) as bigint) as PTS from facts group by PLAYER_ID "
        "order by PTS desc, PLAYER_ID limit 10"
    ),
    "top_k_per_season": (
        "select * from (select SEASON_YEAR, PLAYER_ID, PTS, cast(row_number() over "
        "(partition by SEASON_YEAR order by PTS desc, PLAYER_ID) as bigint) as POS from ("
        "select SEASON_YEAR, PLAYER_ID, cast(sum(PTS) as bigint) as PTS from facts "
        "group by SEASON_YEAR, PLAYER_ID)) where POS <= 5"
    ),
    "landed_past": f"select {_landed_cols()} from past_raw",
    "landed_current": f"select {_landed_cols()} from cur_raw",
    "landed_without_type": (
        f"select {_landed_cols(drop=('GAME_TYPE',))} from past_raw union all select {_landed_cols(drop=('GAME_TYPE',))} from cur_raw"
    ),
    "landed_mixed": (
        f"select {_landed_cols()}, case when cast(SEASON as int) % 2 = 1 then 'player ' || cast(PLAYER_ID as varchar) end as PLAYER_NAME "
        "from games where GAME_DATE is not null"
    ),
    "landed_mixed_folders": (
        f"select {_landed_cols()}, case when cast(GAME_ID as bigint) % 2 = 1 then 'player ' || cast(PLAYER_ID as varchar) end as PLAYER_NAME "
        "from games where GAME_DATE is not null"
    ),
    "landed_with_failure": (
        "select coalesce(r.SEASON, f.SEASON) as SEASON, r.GAME_TYPE, r.N_ROWS, r.PTS, cast(coalesce(f.n, 0) as bigint) as N_FAILED "
        "from (select SEASON, GAME_TYPE, count(*) as N_ROWS, sum(PTS) as PTS from past_raw "
        "where not (GAME_TYPE = 'Playoffs' and SEASON in (select SEASON from broken)) group by all) r "
        "full join broken f on f.SEASON = r.SEASON"
    ),
    "landed_incremental": (
        f"select {_landed_cols()}, SEASON = (select min(SEASON) from found_seasons) or SEASON = "
        "(select max(SEASON) from found_seasons where SEASON < (select max(SEASON) from found_seasons)) as READ_AGAIN from past_raw"
    ),
    "landed_team_past": (
        "select distinct TEAM_ID, GAME_ID, GAME_DATE, SEASON, case when cast(SEASON as int) % 2 = 1 then 'home' end as SIDE from past_raw"
    ),
    "landed_seasons": "select SEASON from found_seasons order by SEASON",
    "merge_job_result": (
        "select * exclude (pos), cast(year(GAME_DATE) as bigint) as GAME_YEAR, true as STAMPED from ("
        "select *, row_number() over (partition by PLAYER_ID, GAME_ID, TEAM_ID order by GAME_DATE desc nulls last, "
        + ", ".join(f"{c} desc nulls last" for c in REST)
        + ") as pos from (select * from cur union all "
        "select * replace (case when GAME_ID % 2 = 0 then PTS + 1 else PTS end as PTS) from past)) where pos = 1"
    ),
    "refreshed_players": "select *, true as STAMPED from dim_players",
    "refreshed_teams": "select *, true as STAMPED from dim_teams",
    "staging_view": "select PLAYER_ID, GAME_ID, TEAM_ID, PTS from games",
    "enforced_schema": (
        "select " + ", ".join("cast(null as double) as BLKA" if c == "BLKA" else c for c in RAW) + " from games"
    ),
    "year_starts": (
        "select PLAYER_ID, GAME_ID, TEAM_ID, cast(date_trunc('year', GAME_DATE) as date) as YEAR_START, "
        "cast(year(GAME_DATE) as bigint) as GAME_YEAR from facts"
    ),
}

# The second of the seasons before the latest.
BODIES["landed_with_failure"] = (
    "select * from (with broken as (select SEASON, 1 as n from found_seasons "
    "where SEASON <> (select max(SEASON) from found_seasons) order by SEASON limit 1 offset 1) "
    + BODIES["landed_with_failure"]
    + ")"
)


def _dashboard_sql() -> str:
    """Every report's own SQL, one row for each of its rows."""
    figures = {
        "facts_named": ("PLAYER_NAME || '/' || TEAM_NAME || '/' || TEAM_ABBREVIATION || '/' || GAME_ID", "null", "PTS", "null"),
        "totals_by_player": ("PLAYER_ID || '/' || GAME_TYPE", "GAMES", "PTS", "null"),
        "totals_by_team": ("TEAM_ID || '/' || GAME_TYPE", "GAMES", "PTS", "null"),
        "totals_by_season_type": ("GAME_TYPE", "GAMES", "PTS", "null"),
        "rank_players": ("PLAYER_ID || '/' || GAME_TYPE", "null", "PTS", "PTS_RANK"),
        "rank_teams": ("TEAM_ID || '/' || GAME_TYPE", "null", "PTS", "PTS_RANK"),
        "trend_team": ("TEAM_ID", "GAMES", "PTS_CHANGE", "null"),
        "trend_player": ("PLAYER_ID", "GAMES", "PTS_CHANGE", "null"),
        "top_k": ("PLAYER_ID", "null", "PTS", "null"),
        "top_k_per_season": ("PLAYER_ID", "null", "PTS", "POS"),
        "compare_teams": ("'1/2/3'", "TEAM_1_PTS", "TEAM_2_PTS", "TEAM_3_PTS"),
    }
    parts = [
        f"select '{name}' as TABLE_NAME, {'null' if name == 'top_k' else 'SEASON_YEAR'} as SEASON_YEAR, cast({entity} as varchar) as ENTITY, "
        f"cast({games} as bigint) as GAMES, cast({pts} as bigint) as PTS, cast({place} as bigint) as PLACE from ({BODIES[name]})"
        for name, (entity, games, pts, place) in figures.items()
    ]
    return " union all ".join(parts)


BODIES["dashboard_tables"] = _dashboard_sql()
BODIES["totals_incremental"] = _totals_sql(["PLAYER_ID", "SEASON_YEAR", "GAME_TYPE"], f"({BODIES['merge_job_result']})")

ORACLE_SQL = {name: PRELUDE + body for name, body in BODIES.items()}
