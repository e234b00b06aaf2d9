"""Hand-made game-log rows for the cases the synthetic tables lack."""

from __future__ import annotations

import datetime as dt

from courtline import schemas

RAW_COLS = schemas.names(schemas.RAW_GAME_LOG)


def game(player=1, team=10, game_id="0022300001", date="2024-01-05", pts=20.0, season="2023-24",
         game_type="Regular Season", **stats):
    row = {c: None for c in RAW_COLS}
    row.update(
        PLAYER_ID=player, TEAM_ID=team, GAME_ID=game_id,
        GAME_DATE=None if date is None else dt.datetime.fromisoformat(date),
        WL="W", PTS=pts, SEASON=season, GAME_TYPE=game_type,
        MIN=30.0, FGM=8.0, FGA=16.0, FG_PCT=0.5, FG3M=2.0, FG3A=5.0, FG3_PCT=0.4,
        FTM=2.0, FTA=2.0, FT_PCT=1.0, OREB=1.0, DREB=4.0, REB=5.0, AST=6.0, TOV=2.0,
        STL=1.0, BLK=0.0, BLKA=0.0, PF=3.0, PFD=2.0, PLUS_MINUS=5.0,
    )
    row.update(stats)
    return tuple(row[c] for c in RAW_COLS)


def frame(spark, rows):
    return spark.createDataFrame(list(rows), schemas.RAW_GAME_LOG)
