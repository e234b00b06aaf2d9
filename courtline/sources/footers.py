"""Least dates from Parquet footers: no data page is read."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import SparkSession

from courtline.sources import storage

_EPOCH = dt.date(1970, 1, 1)
#: Units of a day for the timestamps that Parquet stores as 64-bit integers.
_DAY = {"MILLIS": 86_400_000, "MICROS": 86_400_000_000, "NANOS": 86_400_000_000_000}


class NoStatistics(ValueError):
    """A footer does not tell the least value exactly."""


def least_date(spark: SparkSession, files: list[str], column: str) -> dt.date | None:
    """The least date of ``column`` over ``files``, None if none has one.

    Raises ``NoStatistics`` where it takes the data to tell: text, the old
    96-bit timestamps, instants in a session that is not in UTC, or a file
    written without statistics. One footer after another is read on the
    driver, so this is for the few files of one season.
    """
    found = [d for f in files if (d := _of_file(spark, f, column)) is not None]
    return min(found, default=None)


def _of_file(spark: SparkSession, file: str, column: str) -> dt.date | None:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.parquet.hadoop
    reader = hadoop.ParquetFileReader.open(
        hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), spark.sparkContext._jsc.hadoopConfiguration())
    )
    try:
        least = None
        for block in reader.getFooter().getBlocks():
            for chunk in block.getColumns():
                if chunk.getPath().toDotString() != column:
                    continue
                told = chunk.getStatistics()
                if told is not None and told.isNumNullsSet() and told.getNumNulls() == chunk.getValueCount():
                    continue
                day = _day(spark, chunk.getPrimitiveType())
                if told is None or told.isEmpty() or not told.hasNonNullValue():
                    raise NoStatistics(f"{file}: {column} has no statistics")
                value = told.genericGetMin() // day
                least = value if least is None else min(least, value)
    finally:
        reader.close()
    return None if least is None else _EPOCH + dt.timedelta(days=least)


def _day(spark: SparkSession, kind) -> int:
    """How many of a column's units are a day."""
    logical, physical = kind.getLogicalTypeAnnotation(), kind.getPrimitiveTypeName().name()
    said = "" if logical is None else logical.toString()
    if physical == "INT32" and said == "DATE":
        return 1
    if physical == "INT64" and said.startswith("TIMESTAMP("):
        unit, adjusted = said.removeprefix("TIMESTAMP(").rstrip(")").split(",")
        if adjusted == "false" or spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
            return _DAY[unit]
    raise NoStatistics(f"{physical} {said} does not tell a least date")


def season_files(spark: SparkSession, root: str, season: str, columns=("SEASON", "GAME_TYPE"), keep=None) -> list[str]:
    """The extract files of one season (and of the game types that ``keep`` takes)."""
    out = []
    for values in storage.leaf_folders(spark, root, columns):
        plain = [unquote(v) for v in values]
        if plain[0] == season and (keep is None or keep(plain)):
            folder = "/".join([root.rstrip("/"), *(f"{c}={v}" for c, v in zip(columns, values, strict=True))])
            out += [f"{folder}/{n}" for n in storage.list_data_files(spark, folder)]
    return out
