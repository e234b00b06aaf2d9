"""Conform raw frames to the typed contract.

Every conform is one ``select`` of cast expressions, so the whole thing is a
single projection inside the scan's code-generated stage: no shuffle, and
Catalyst prunes the columns a later step does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import schemas
from courtline.functions import columns as fn


class SchemaMismatch(ValueError):
    """Raised when a frame lacks columns that the contract requires."""

    def __init__(self, missing, extra):
        self.missing = list(missing)
        self.extra = list(extra)
        super().__init__(f"missing columns {self.missing}; extra columns {self.extra}")


def check_columns(df: DataFrame, schema: T.StructType) -> tuple[list[str], list[str]]:
    """List the contract columns a frame lacks and the ones it has in excess."""
    have = {c.upper(): c for c in df.columns}
    want = [f.name for f in schema.fields]
    want_up = {w.upper() for w in want}
    missing = [w for w in want if w.upper() not in have]
    extra = [c for c in df.columns if c.upper() not in want_up]
    return missing, extra


def require_columns(df: DataFrame, schema: T.StructType, allow_extra: bool = True) -> DataFrame:
    missing, extra = check_columns(df, schema)
    if missing or (extra and not allow_extra):
        raise SchemaMismatch(missing, [] if allow_extra else extra)
    return df


def enforce_schema(df: DataFrame, schema: T.StructType, fill_missing: bool = False) -> DataFrame:
    """Select the contract columns by name and cast them to the contract types.

    ``fill_missing`` adds absent columns as typed nulls (the by-name union
    rule); otherwise an absent column raises ``SchemaMismatch``.
    """
    missing, _ = check_columns(df, schema)
    if missing and not fill_missing:
        raise SchemaMismatch(missing, [])
    types = dict(df.dtypes)
    out = []
    for f in schema.fields:
        if f.name in missing:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[f.name] == f.dataType.simpleString():
            out.append(F.col(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def fill_stats(df: DataFrame, cols=schemas.FILL_ZERO_STATS) -> DataFrame:
    """Nulls and NaN become 0 on the named statistics, which are then integers.

    Other columns keep their nulls.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    repl = {c: fn.to_bigint(fn.zero_if_null(c, types[c]), types[c]).alias(c) for c in cols if c in types}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_all(df: DataFrame) -> DataFrame:
    """Whole-frame fill of nulls and NaN with 0: numeric columns only, text keeps nulls."""
    return df.fillna(0)


def parse_dates(df: DataFrame, cols=("GAME_DATE",), fmt: str | None = None) -> DataFrame:
    """Text date-times become timestamps (date-times pass through)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    repl = {c: fn.parse_datetime(c, types[c], fmt).alias(c) for c in cols if c in types}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def conform_games(raw: DataFrame, stamp: bool = True, strict: bool = True) -> DataFrame:
    """Typed projection of a raw game log into the 31-column fact shape.

    The key ``ID`` is built from the raw values before GAME_ID is cast, so
    it keeps the leading zeros that the integer GAME_ID loses. SEASON is
    renamed SEASON_YEAR. ``stamp`` adds the LAST_UPDATE load time. Casts are
    strict (a malformed value fails the query, as the warehouse does);
    ``strict=False`` turns such values into nulls (see ``split_cast_rejects``).
    """
    required = schemas.without(schemas.RAW_GAME_LOG)
    require_columns(raw, required)
    cols = [e.alias(n) for n, e in _typed_exprs(raw, strict).items()]
    cols += [
        fn.game_key().alias("ID"),
        F.col("GAME_TYPE").cast("string").alias("GAME_TYPE"),
        F.col("SEASON").cast("string").alias("SEASON_YEAR"),
    ]
    if stamp:
        cols.append(F.current_timestamp().alias("LAST_UPDATE"))
    return raw.select(*cols)


def _typed_exprs(raw: DataFrame, strict: bool = True) -> dict:
    """Typed expression of every cast column of the fact, by output name."""
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    out = {
        "PLAYER_ID": fn.to_bigint("PLAYER_ID", types["PLAYER_ID"], strict),
        "TEAM_ID": fn.to_bigint("TEAM_ID", types["TEAM_ID"], strict),
        "GAME_ID": fn.to_bigint("GAME_ID", types["GAME_ID"], strict),
        "GAME_DATE": fn.to_date("GAME_DATE", strict),
        "WL": F.col("WL").cast("string"),
    }
    for c in schemas.FACT_STAT_ORDER:
        if c in schemas.RATIO_STATS:
            out[c] = fn.to_decimal(c, types[c], strict=strict)
        else:
            out[c] = fn.to_bigint(c, types[c], strict)
    return out


def split_cast_rejects(raw: DataFrame, stamp: bool = True) -> tuple[DataFrame, DataFrame]:
    """(typed rows, raw rows that a strict cast would fail on).

    A row is rejected when some column has a value whose lenient cast is
    null (malformed text, overflow). The rejects keep their raw values and
    list the failing columns in ``REJECTED_COLUMNS``; the other rows are
    conformed with strict casts, which cannot fail on them. One pass, no
    shuffle.
    """
    require_columns(raw, schemas.without(schemas.RAW_GAME_LOG))
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    lenient = _typed_exprs(raw, strict=False)
    failed = F.filter(
        F.array(*[F.when(fn.missing_as_null(n, types[n]).isNotNull() & e.isNull(), F.lit(n)) for n, e in lenient.items()]),
        lambda x: x.isNotNull(),
    )
    flagged = raw.withColumn("REJECTED_COLUMNS", failed)
    bad = F.size("REJECTED_COLUMNS") > 0
    good = conform_games(flagged.where(~bad).drop("REJECTED_COLUMNS"), stamp=stamp)
    return good, flagged.where(bad)


def conform_players(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """Player dimension: typed projection of the landed player list."""
    require_columns(raw, schemas.RAW_PLAYERS)
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    cols = [
        fn.to_bigint("id", types["id"]).alias("ID"),
        F.col("full_name").cast("string").alias("FULL_NAME"),
        F.col("first_name").cast("string").alias("FIRST_NAME"),
        F.col("last_name").cast("string").alias("LAST_NAME"),
        F.col("is_active").cast("boolean").alias("IS_ACTIVE"),
    ]
    if stamp:
        cols.append(F.current_timestamp().alias("LAST_UPDATE"))
    return raw.select(*cols)


def conform_teams(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """Team dimension: typed projection of the landed team list."""
    require_columns(raw, schemas.RAW_TEAMS)
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    cols = [
        fn.to_bigint("id", types["id"]).alias("ID"),
        F.col("full_name").cast("string").alias("FULL_NAME"),
        F.col("abbreviation").cast("string").alias("ABBREVIATION"),
        F.col("nickname").cast("string").alias("NICKNAME"),
        F.col("city").cast("string").alias("CITY"),
        F.col("state").cast("string").alias("STATE"),
        fn.to_bigint("year_founded", types["year_founded"]).alias("YEAR_FOUNDED"),
    ]
    if stamp:
        cols.append(F.current_timestamp().alias("LAST_UPDATE"))
    return raw.select(*cols)


def split_null_keys(df: DataFrame, keys=schemas.KEY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows with a null key part)."""
    bad = None
    for k in keys:
        bad = F.col(k).isNull() if bad is None else (bad | F.col(k).isNull())
    return df.where(~bad), df.where(bad)
