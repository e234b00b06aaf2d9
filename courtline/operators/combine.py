"""Unions: positional, by name (missing columns become null), and folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Positional UNION ALL of frames that share one projection.

    Positional unions silently pair columns by position, so the column names
    are checked to be identical and in the same order first.
    """
    for o in others:
        if [c.upper() for c in o.columns] != [c.upper() for c in first.columns]:
            raise ValueError(f"positional union of different columns: {first.columns} vs {o.columns}")
    return reduce(lambda a, b: a.union(b), others, first)


def union_by_name(first: DataFrame, *others: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union by column name; with ``allow_missing`` absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), others, first)


def append_all(frames, allow_missing: bool = True) -> DataFrame:
    """Append many frames by name (a landed multi-path scan is preferred)."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to append")
    return union_by_name(frames[0], *frames[1:], allow_missing=allow_missing)
