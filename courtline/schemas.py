"""Typed contracts for landed extracts, staging tables and core tables.

The core types follow the SQL models of the pipeline being rebuilt: integers
are 64-bit, decimals carry an explicit precision (a bare ``decimal`` is
(10,0) in Spark and would turn 0.457 into 0), dates are dates.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG = T.LongType()
STRING = T.StringType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
BOOLEAN = T.BooleanType()
TIMESTAMP = T.TimestampType()
DECIMAL = T.DecimalType(38, 9)

# Grain of the fact table: one row per player, game and team.
KEY_COLUMNS = ("PLAYER_ID", "GAME_ID", "TEAM_ID")

# Partition column of the fact table layout (year of GAME_DATE) and the
# clustering columns used to sort rows inside each written file.
PARTITION_COLUMN = "GAME_YEAR"
CLUSTER_COLUMNS = ("TEAM_ID", "PLAYER_ID")

# Statistics that are ratios or minutes, not counts.
RATIO_STATS = ("MIN", "FG_PCT", "FG3_PCT", "FT_PCT")

# Statistics that the landing step fills with 0 before casting to integer.
# The fill list of the landing tasks.
FILL_ZERO_STATS = ("FTA", "REB", "AST", "PF")

# The statistic columns of a player game log, in the order of the fact table.
FACT_STAT_ORDER = (
    "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
    "FT_PCT", "OREB", "DREB", "REB", "AST", "TOV", "STL", "BLK", "BLKA", "PF",
    "PFD", "PTS", "PLUS_MINUS",
)


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw player game log as landed (one extract per season and game type).
# Counting stats arrive as floating point because missing values are NaN in
# the extracts; GAME_ID is text with leading zeros.
RAW_GAME_LOG = _struct(
    [("PLAYER_ID", LONG), ("TEAM_ID", LONG), ("GAME_ID", STRING),
     ("GAME_DATE", T.TimestampNTZType()), ("WL", STRING)]
    + [(c, DOUBLE) for c in FACT_STAT_ORDER]
    + [("GAME_TYPE", STRING), ("SEASON", STRING)]
)

# Core fact table (31 columns), partitioned by GAME_YEAR when written.
FACT = _struct(
    [("PLAYER_ID", LONG), ("TEAM_ID", LONG), ("GAME_ID", LONG),
     ("GAME_DATE", DATE), ("WL", STRING)]
    + [(c, DECIMAL if c in RATIO_STATS else LONG) for c in FACT_STAT_ORDER]
    + [("ID", STRING), ("GAME_TYPE", STRING), ("SEASON_YEAR", STRING),
       ("LAST_UPDATE", TIMESTAMP)]
)

# The columns of the landed player list.
RAW_PLAYERS = _struct(
    [("id", LONG), ("full_name", STRING), ("first_name", STRING),
     ("last_name", STRING), ("is_active", BOOLEAN)]
)

PLAYERS = _struct(
    [("ID", LONG), ("FULL_NAME", STRING), ("FIRST_NAME", STRING),
     ("LAST_NAME", STRING), ("IS_ACTIVE", BOOLEAN), ("LAST_UPDATE", TIMESTAMP)]
)

# The columns of the landed team list.
RAW_TEAMS = _struct(
    [("id", LONG), ("full_name", STRING), ("abbreviation", STRING),
     ("nickname", STRING), ("city", STRING), ("state", STRING),
     ("year_founded", LONG)]
)

TEAMS = _struct(
    [("ID", LONG), ("FULL_NAME", STRING), ("ABBREVIATION", STRING),
     ("NICKNAME", STRING), ("CITY", STRING), ("STATE", STRING),
     ("YEAR_FOUNDED", LONG), ("LAST_UPDATE", TIMESTAMP)]
)

# Per-team yearly totals: only YEAR is read (to list the seasons to load).
TEAM_YEAR_TOTALS = _struct([("TEAM_ID", LONG), ("YEAR", STRING)])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def without(schema: T.StructType, *drop: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in drop])
