"""Readers of landed extracts.

Per-season (and per-game-type) extracts are laid out as partition folders,
``root/SEASON=2001-02/GAME_TYPE=Playoffs/part-*.parquet``. Partition folders
supply the SEASON and GAME_TYPE tags and are pruned by listing, before any
file is opened. Extracts differ in their physical types (a statistic is an
integer in a season without missing values, a date is text or a date-time) and
in their columns, also within a folder. Spark's own schema merge reads the
footers of all files in one distributed job; where it finds types that do not
agree or a file that is none, the files are parted by the job that wrote them,
and these parts are halved, until each part merges.
Parts whose types agree are read in one scan, conformed, and the scans are
appended by name. A folder with an unreadable file can be set aside.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import schemas
from courtline.functions import columns as fn
from courtline.operators import combine
from courtline.sources import storage

# Folder name Spark gives the partition of a null value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


# Name of a file that Spark wrote: the id is that of the write job.
_WRITE = re.compile(r"part-\d+-([0-9a-f-]{36})")


def list_seasons(spark: SparkSession, root: str, column: str = "SEASON") -> list[str]:
    """Seasons that have a folder under ``root``, ascending; rows without a season aren't one."""
    found = storage.list_partition_values(spark, root, column)
    return sorted(unquote(v) for v in found if v != NULL_FOLDER)


def _as(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A raw value in the contract's type; NaN and fractions are the conform's to judge."""
    if have == want:
        return c
    if isinstance(want, T.TimestampNTZType):
        return fn.parse_datetime(c, have)
    return c.cast(want)


def _common(types: list[T.DataType]) -> T.DataType:
    """One type for a column that is in no contract: the widest number, else text."""
    first = types[0]
    if all(t == first for t in types):
        return first
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    return T.DoubleType() if all(isinstance(t, T.NumericType) for t in types) else T.StringType()


@dataclass
class Scan:
    """Files whose columns of one name have one type: one scan reads them, a column that a file lacks is null there."""

    schema: T.StructType
    files: list[str] = field(default_factory=list)

    def takes(self, schema: T.StructType) -> bool:
        have = {f.name: f.dataType for f in self.schema.fields}
        return all(have.get(f.name, f.dataType) == f.dataType for f in schema.fields)

    def add(self, other: Scan) -> None:
        have = set(self.schema.names)
        self.schema = T.StructType(self.schema.fields + [f for f in other.schema.fields if f.name not in have])
        self.files += other.files


class UnreadableExtract(ValueError):
    def __init__(self, failed: list[tuple[str, str]]):
        self.failed = failed
        super().__init__(f"{len(failed)} extract files cannot be read, e.g. {failed[0][0]}: {failed[0][1]}")


def _footers(spark: SparkSession, root: str, files: list[str], drop) -> tuple[list[Scan], list[tuple[str, str]]]:
    """The scans that read ``files``, and (file, error) of those that can't be.

    One distributed job reads all footers; where it fails, the files of each
    write job (which share its id in their names) are tried together, and only
    where these fail, each half of them.
    """
    try:
        schema = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*files).schema
        return [Scan(T.StructType([f for f in schema.fields if f.name not in drop]), list(files))], []
    except (PySparkException, Py4JJavaError) as e:
        if len(files) == 1:
            said = e.java_exception.getMessage() if isinstance(e, Py4JJavaError) else str(e)
            return [], [(files[0], (said or type(e).__name__).strip().split("\n")[0][:500])]
    half = len(files) // 2
    scans: list[Scan] = []
    failed: list[tuple[str, str]] = []
    for part in _by_write(files) or (files[:half], files[half:]):
        found, bad = _footers(spark, root, part, drop)
        for scan in found:
            fits = next((s for s in scans if s.takes(scan.schema)), None)
            if fits is None:
                scans.append(scan)
            else:
                fits.add(scan)
        failed += bad
    return scans, failed


def _by_write(files: list[str]) -> list[list[str]]:
    """The files of each write job; none where there is one job, or nearly as many as files."""
    jobs: dict[str, list[str]] = {}
    for f in files:
        name = f.rpartition("/")[2]
        made = _WRITE.match(name)
        jobs.setdefault(made[1] if made else "", []).append(f)
    return list(jobs.values()) if 1 < len(jobs) <= len(files) // 2 else []


def read_laid_out(
    spark: SparkSession,
    root: str,
    partition_cols=("SEASON",),
    contract: T.StructType | None = None,
    keep=None,
    failed: list | None = None,
) -> DataFrame:
    """All extracts under ``root``, appended by name, every column of every file kept.

    Columns of ``contract`` get its type whatever an extract stored; other
    columns keep theirs, or the widest where extracts differ; a column that an
    extract lacks is null there (a contract column that none has is all null).
    Partition values are text: discovery would otherwise turn a folder
    ``SEASON=2001`` into an integer column and ``SEASON=2001-02`` into text.
    ``keep`` (of a tuple of partition values, None for null) selects folders.

    An unreadable file raises ``UnreadableExtract`` before any data is read.
    With a list as ``failed``, its whole folder is left out instead (half an
    extract would pass for a whole one), and (partition values, file, error)
    is appended for each such file.
    """
    partition_cols = list(partition_cols)
    root = root.rstrip("/")
    folders: dict[str, tuple] = {}
    files: list[str] = []
    for values in storage.leaf_folders(spark, root, partition_cols):
        plain = tuple(None if v == NULL_FOLDER else unquote(v) for v in values)
        if keep is not None and not keep(plain):
            continue
        folder = "/".join([root, *(f"{c}={v}" for c, v in zip(partition_cols, values, strict=True))])
        for name in storage.list_data_files(spark, folder):
            files.append(f"{folder}/{name}")
            folders[files[-1]] = plain
    scans, bad = _footers(spark, root, files, set(partition_cols)) if files else ([], [])
    if bad:
        if failed is None:
            raise UnreadableExtract(bad)
        failed += [(folders[f], f, error) for f, error in bad]
        gone = {folders[f] for f, _ in bad}
        for scan in scans:
            scan.files = [f for f in scan.files if folders[f] not in gone]
        scans = [s for s in scans if s.files]
    tags = [T.StructField(c, T.StringType(), True) for c in partition_cols]
    wanted = {f.name: f.dataType for f in (contract.fields if contract is not None else []) if f.name not in partition_cols}
    loose: dict[str, list[T.DataType]] = {}
    for scan in scans:
        for f in scan.schema.fields:
            if f.name not in wanted:
                loose.setdefault(f.name, []).append(f.dataType)
    kinds = wanted | {c: _common(ts) for c, ts in loose.items()}
    names = [*kinds, *partition_cols]
    frames = []
    for scan in scans:
        have = {f.name: f.dataType for f in scan.schema.fields}
        df = spark.read.schema(T.StructType(scan.schema.fields + tags)).option("basePath", root).parquet(*_paths(scan.files, files))
        frames.append(
            df.select(
                *[(_as(F.col(c), have[c], t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()],
                *partition_cols,
            )
        )
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(c, kinds.get(c, T.StringType()), True) for c in names]))
    return combine.append_all(frames)


def _paths(files: list[str], all_files: list[str]) -> list[str]:
    """``files``, or the folder for those that are all of its files."""
    count: dict[str, int] = {}
    for f in all_files:
        folder = f.rpartition("/")[0]
        count[folder] = count.get(folder, 0) + 1
    own: dict[str, list[str]] = {}
    for f in files:
        own.setdefault(f.rpartition("/")[0], []).append(f)
    return [p for folder, fs in own.items() for p in ([folder] if len(fs) == count[folder] else fs)]


def read_game_logs(
    spark: SparkSession,
    root: str,
    seasons=None,
    game_types=None,
    schema: T.StructType = schemas.RAW_GAME_LOG,
    with_game_type: bool = True,
    failed: list | None = None,
) -> DataFrame:
    """Game logs laid out ``SEASON=…[/GAME_TYPE=…]`` as one DataFrame, with the extracts' other columns.

    ``with_game_type=False`` reads the layout without a game-type level; the
    frame then has no GAME_TYPE column.
    """
    tags = ["SEASON", "GAME_TYPE"] if with_game_type else ["SEASON"]
    seasons = None if seasons is None else {str(s) for s in seasons}
    game_types = None if game_types is None else {str(g) for g in game_types}

    def keep(values: tuple) -> bool:
        if seasons is not None and values[0] not in seasons:
            return False
        return not with_game_type or game_types is None or values[1] in game_types

    contract = schema if with_game_type else schemas.without(schema, "GAME_TYPE")
    return read_laid_out(spark, root, tags, contract, keep, failed)


def read_team_year_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per-team yearly totals laid out ``TEAM_ID=…/``, or with TEAM_ID in files of many teams, in one scan."""
    totals = spark.read.schema(schemas.TEAM_YEAR_TOTALS).option("basePath", root).parquet(root)
    return totals.select(*schemas.TEAM_YEAR_TOTALS.names)


def read_list(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A landed player or team list (Parquet or JSON lines)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)
