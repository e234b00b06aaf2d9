"""Scalar functions: casts, composite key, date helpers, null fills."""

from courtline.functions.columns import (
    game_key,
    game_year,
    parse_datetime,
    safe_ratio,
    to_bigint,
    to_date,
    to_decimal,
    year_start,
    zero_if_null,
)

__all__ = [
    "game_key",
    "game_year",
    "parse_datetime",
    "safe_ratio",
    "to_bigint",
    "to_date",
    "to_decimal",
    "year_start",
    "zero_if_null",
]
