"""Scalar column functions (casts, key, dates, null fills).

All of them return built-in Spark expressions, so they stay inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import schemas


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cast(c: Column, to, strict: bool) -> Column:
    return c.cast(to) if strict else c.try_cast(to)


def missing_as_null(c, source_type: T.DataType | None = None) -> Column:
    """NaN, which extracts carry for a missing value, becomes null (floating inputs only)."""
    c = _col(c)
    if isinstance(source_type, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def to_bigint(c, source_type: T.DataType | None = None, strict: bool = True) -> Column:
    """Cast to a 64-bit integer the way the warehouse does; NaN is null.

    Fractional inputs are rounded half away from zero first (Spark's plain
    cast truncates, so 2.5 would become 2). Integral inputs are cast as is,
    which keeps ids above 2**53 exact. Text is cast strictly: '0022300001'
    becomes 22300001 and a malformed value raises under ANSI mode.
    ``strict=False`` gives null instead of an error (``try_cast``).
    """
    c = missing_as_null(c, source_type)
    if isinstance(source_type, (T.IntegralType, T.StringType)):
        return _cast(c, schemas.LONG, strict)
    if isinstance(source_type, T.BooleanType):
        return c.cast("int").cast(schemas.LONG)
    if isinstance(source_type, (T.FloatType, T.DoubleType)):
        return _half_away(c.cast("double"), strict)
    return _cast(F.round(c), schemas.LONG, strict)


def _half_away(c: Column, strict: bool) -> Column:
    """A double rounded half away from zero, as bigint: its whole part, and that of twice the rest.

    Both are exact. ``round`` makes a decimal number of each value.
    """
    whole = _cast(c, schemas.LONG, strict)
    return whole + ((c - whole) * 2).cast(schemas.LONG)


def to_decimal(c, source_type: T.DataType | None = None, precision: int = 38, scale: int = 9, strict: bool = True) -> Column:
    """Cast to a decimal; NaN is null."""
    return _cast(missing_as_null(c, source_type), T.DecimalType(precision, scale), strict)


def to_date(c, strict: bool = True) -> Column:
    """Date part of a date-time (or a 'yyyy-MM-dd...' text)."""
    return _cast(_col(c), schemas.DATE, strict)


def parse_datetime(c, source_type: T.DataType | None = None, fmt: str | None = None) -> Column:
    """Text to date-time; date-times pass through unchanged."""
    c = _col(c)
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(source_type, T.DateType):
        return c.cast(T.TimestampNTZType())
    return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)


def game_key(player="PLAYER_ID", game="GAME_ID", team="TEAM_ID") -> Column:
    """Serialised composite key ``PLAYER_ID || GAME_ID || TEAM_ID``.

    Built from the raw values, so the leading zeros of the text GAME_ID are
    kept. Null if any part is null. Without a separator the string is not
    injective ((1, 23) and (12, 3) collide), so merges match on the three
    key columns and this string is only an output column.
    """
    return F.concat(
        _col(player).cast("string"), _col(game).cast("string"), _col(team).cast("string")
    )


def year_start(c) -> Column:
    """DATE_TRUNC(date, YEAR) as a date."""
    return F.trunc(_col(c).cast(schemas.DATE), "year")


def game_year(c="GAME_DATE") -> Column:
    """Partition value of the fact table layout: the calendar year, as bigint."""
    return F.year(_col(c)).cast(schemas.LONG)


def zero_if_null(c, source_type: T.DataType | None = None) -> Column:
    """0 for null and, on floating inputs, for NaN."""
    return F.coalesce(missing_as_null(c, source_type), F.lit(0))


def safe_ratio(num, den) -> Column:
    """num / den as double, null when den is 0 or null (ANSI division raises)."""
    den = _col(den)
    return _col(num).cast("double") / F.when(den != 0, den.cast("double"))
