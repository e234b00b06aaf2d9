"""Keyed incremental merge of the fact table on plain Parquet.

Semantics of one run (incremental model with a unique key):

* incoming = current rows UNION ALL past rows whose key is not in the target
  (past rows are only inserted, never updated);
* target rows whose key is incoming are replaced, other target rows stay;
* the table is partitioned by the year of GAME_DATE and clustered by
  TEAM_ID, PLAYER_ID inside each year.

Keys are matched on the three key columns, not on the concatenated ``ID``
string, which is ambiguous without a separator. Null key parts are rejected
and duplicate incoming keys fail the run (or keep the latest row with
``on_duplicate="latest"``), as a warehouse MERGE does.

A run never changes files a reader may hold. It writes new folders of its own
and then commits a manifest that names the folders of each year; the highest
manifest is the table. A year of which a row is replaced is written anew, one
that only gets rows has them in a further folder, beside those it has; with
``MAX_FOLDERS`` of them it is written anew as well. A run that fails at any
point leaves the table as it was, and running it again is safe.

Runs may overlap. A run remembers the version it read and commits the next one
only if no other run has. If one has, the years that it changed are compared
with what this run read: if they hold none of its keys and none of its years,
its own years are put into the newer manifest; else the run is made anew on it.
So the outcome is that of some order of the runs.

Beside each year's rows lie its keys, bucketed by key. A run matches its keys
there: the target side of that join is read as it lies, without an exchange.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline import schemas, session
from courtline.functions import columns as fn
from courtline.operators.combine import union_all
from courtline.operators.conform import split_null_keys
from courtline.sources import storage

KEYS = list(schemas.KEY_COLUMNS)
YEAR = schemas.PARTITION_COLUMN


class NullKeyError(ValueError):
    def __init__(self, rows: int, rejects: DataFrame | None = None):
        self.rows = rows
        self.rejects = rejects
        super().__init__(f"{rows} incoming rows have a null key part {KEYS}")


class DuplicateKeyError(ValueError):
    def __init__(self, keys: int, sample):
        self.keys = keys
        self.sample = sample
        super().__init__(f"{keys} keys occur more than once in one batch, e.g. {sample}")


# ---------------------------------------------------------------- plans ---


def new_keys(source: DataFrame, target: DataFrame, keys=KEYS, narrow: bool = True) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``.

    Two steps, so that the wide source rows are not shuffled just to learn
    that most of their keys already exist:

    1. an anti join of the distinct source *keys* against the target keys (a
       narrow shuffle of three columns on each side; the distinct is reduced
       inside each task first, so a heavily repeated key does not pile up in
       one task, and the join reuses its partitioning);
    2. a semi join of the source rows with those new keys, on null-safe
       equality (a row with a null key part is new, as in a plain anti join).
       When few keys are new, AQE broadcasts them and the source rows are
       filtered where they are read; otherwise it is an ordinary shuffle join.

    ``narrow=False`` is the one-step anti join of the wide rows, cheaper when
    most keys are new (a first load or a backfill).

    The single-column ``NOT IN`` form would be planned as a null-aware
    broadcast of every target key, which does not scale with the table.
    """
    if not narrow:
        return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)
    fresh = source.select(*keys).distinct().join(target.select(*keys), list(keys), "left_anti")
    f = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    cond = None
    for k in keys:
        c = source[k].eqNullSafe(f[f"_new_{k}"])
        cond = c if cond is None else cond & c
    return source.join(f, cond, "left_semi")


def merge_plan(target: DataFrame, current: DataFrame, past: DataFrame, keys=KEYS) -> DataFrame:
    """The merged table as one DataFrame (what a run would leave behind).

    Rows are tagged current, target or past, united once, and those of the
    first tag that a key has are kept: a key's current rows, else its target
    rows, else its past rows. One shuffle of the wide rows, on the key. Rows
    with a null key part match nothing and all stay.
    """
    tagged = [df.select(*target.columns, F.lit(n).alias("_tag")) for n, df in enumerate((current, target, past))]
    rows = union_all(*tagged)
    first = F.min("_tag").over(Window.partitionBy(*keys))
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return rows.withColumn("_first", first).where((F.col("_tag") == F.col("_first")) | ~complete).drop("_tag", "_first")


def sample_limit(df: DataFrame, n: int | None, order=("ID",) + schemas.KEY_COLUMNS) -> DataFrame:
    """Test-run sample: the first ``n`` rows in a total order (off when None). For reading; no writer takes it."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n)


def duplicate_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    """Keys that occur more than once (partial counts are combined map-side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("N_ROWS")).where(F.col("N_ROWS") > 1)


def keep_latest(df: DataFrame, keys=KEYS, order=("GAME_DATE", "LAST_UPDATE")) -> DataFrame:
    """One row per key: the greatest by ``order``, then by every other column.

    A ``max`` over a struct has a map-side partial step, so a key that holds a
    large share of the rows is reduced inside each task before anything is
    shuffled (a window per key would not be). The partial step sorts the wide
    rows of a task by key (a sort aggregate), which a hash aggregate of
    fixed-width values would not.
    """
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest]).select(*df.columns)


def key_report(df: DataFrame, keys=KEYS) -> dict:
    """Null-key rows and duplicated keys in one pass over ``df``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    row = per_key.agg(
        F.coalesce(F.sum(F.when(null_any, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count(F.when(~null_any & (F.col("n") > 1), F.lit(1))).alias("dup_keys"),
        F.coalesce(F.sum(F.when(~null_any & (F.col("n") > 1), F.col("n") - 1)), F.lit(0)).alias("dup_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    ).first()
    return row.asDict()


def keep_latest_of(df: DataFrame, again: DataFrame, keys=KEYS) -> DataFrame:
    """``keep_latest`` of the rows whose key is in ``again``, beside all others as they are (no key part is null).

    Where few keys repeat, they are broadcast, and only their rows are shuffled.
    """
    keys = list(keys)
    once = df.join(again.select(*keys), keys, "left_anti").select(*df.columns)
    return once.union(keep_latest(df.join(again.select(*keys), keys, "left_semi").select(*df.columns), keys))


def validate_keys(df: DataFrame, keys=KEYS, on_duplicate: str = "error", hold=lambda again: again) -> tuple[DataFrame, dict]:
    """Raise on null key parts; raise or keep the latest row on duplicates.

    Returns the (possibly de-duplicated) frame and the key report. ``hold``
    may store the repeated keys, which the frame reads twice.
    """
    rep = key_report(df, keys)
    if rep["null_rows"]:
        raise NullKeyError(rep["null_rows"], split_null_keys(df, keys)[1])
    if rep["dup_keys"]:
        if on_duplicate == "latest":
            return keep_latest_of(df, hold(duplicate_keys(df, keys).select(*keys)), keys), rep
        sample = [tuple(r) for r in duplicate_keys(df, keys).limit(5).collect()]
        raise DuplicateKeyError(rep["dup_keys"], sample)
    return df, rep


# --------------------------------------------------------------- layout ---


def with_year(df: DataFrame) -> DataFrame:
    if YEAR in df.columns:
        return df
    return df.withColumn(YEAR, fn.game_year("GAME_DATE"))


#: Quantile ranks of a clustering column, as bits.
RANK_BITS = 5


def curve(df: DataFrame, columns=schemas.CLUSTER_COLUMNS) -> Column:
    """Places of rows on a space-filling curve over the ranks of ``columns``: their bits taken in turn.

    Ranks are between quantiles of the column (one aggregate of these columns),
    so that an uneven spread of ids makes no uneven cells. Rows near each other
    on the curve are near in every column, not only in the first.
    """
    n = 1 << RANK_BITS
    at = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = df.agg(*[F.percentile_approx(c, at, F.lit(100 * n)).alias(c) for c in columns]).first()
    place = F.lit(0)
    for i, c in enumerate(columns):
        to = [bit * len(columns) + len(columns) - 1 - i for bit in range(RANK_BITS)]
        places = [sum((rank >> bit & 1) << at for bit, at in enumerate(to)) for rank in range(n)]
        if cuts[c]:
            place = place.bitwiseOR(_by_rank(cuts[c], F.col(c), places))
    return place


def _by_rank(cuts: list, value: Column, of: list) -> Column:
    """``of[r]`` for the number r of ``cuts`` (ascending) up to ``value``, found by halving; ``of[0]`` for null."""

    def among(least: int, most: int) -> Column:
        if least == most:
            return F.lit(of[least])
        half = (least + most + 1) // 2
        return F.when(value < cuts[half - 1], among(least, half - 1)).otherwise(among(half, most))

    return F.when(value.isNull(), F.lit(of[0])).otherwise(among(0, len(cuts)))


def clustered(df: DataFrame) -> DataFrame:
    """Range-partition on year and the curve over team and player, and sort inside files.

    Range partitioning spreads one large year over many tasks (GAME_ID at the
    end splits even a single hot team and player), and each written file holds
    a narrow range of teams and one of players, so that file bounds and Parquet
    statistics skip for either. The number of ranges is the session's
    ``spark.sql.shuffle.partitions``; AQE merges small ones.
    """
    df = with_year(df)
    placed = df.withColumn("_place", curve(df))
    placed = placed.repartitionByRange(YEAR, "_place", *schemas.CLUSTER_COLUMNS, "GAME_ID")
    return placed.sortWithinPartitions(YEAR, "_place", *schemas.CLUSTER_COLUMNS).drop("_place")


# Upper bound of rows per written file of the fact table (a split bound on
# file size, not a cap on data: a task with more rows writes more files).
MAX_RECORDS_PER_FILE = 5_000_000

# Folders that a year lies in at most: one that has as many is written anew when it gets rows.
MAX_FOLDERS = 8

# Partition column above the year folders: the run that wrote them.
_RUN = "RUN"

FACT_TABLE_SCHEMA = T.StructType(schemas.FACT.fields + [T.StructField(YEAR, schemas.LONG, True)])
_BOUNDS = T.StructType([T.StructField("file", T.StringType(), True)] + [T.StructField(f"{n}_{c}", schemas.LONG, True) for c in schemas.CLUSTER_COLUMNS for n in ("least", "most")])
_KEY_SCHEMA = T.StructType([f for f in schemas.FACT.fields if f.name in KEYS])


class ConcurrentRuns(RuntimeError):
    """Other runs committed first, again and again."""


@dataclass
class MergeResult:
    path: str
    mode: str
    incoming_rows: int
    years_written: list = field(default_factory=list)
    years_dropped: list = field(default_factory=list)
    version: int = 0
    #: How often the run was made anew or put on a newer version, because another one had committed.
    conflicts: int = 0


class FactTable:
    """The year-partitioned, keyed fact table at ``path``.

    ``path/_manifests/<n>.json`` names, for each year, the folders
    ``data/RUN=<run>/GAME_YEAR=<year>`` with its rows and those under
    ``keys`` with its keys in buckets; ``bounds/RUN=<run>`` has the least and
    greatest team and player of each file. The buckets' number is set when the table is
    created (``buckets``, or that session's ``spark.sql.shuffle.partitions``);
    a join reads them as they lie in sessions with no more shuffle partitions.
    The highest n is the table. Folders that no kept manifest names are
    removed by ``vacuum``.
    """

    def __init__(self, path: str, buckets: int | None = None):
        self.path = path.rstrip("/")
        self.rejects_path = self.path + "_rejects"
        self.manifests = f"{self.path}/_manifests"
        self.buckets = buckets

    # -------------------------------------------------------------- read ---

    def versions(self, spark: SparkSession) -> list[int]:
        names = storage.list_names(spark, self.manifests)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _entries(self, spark: SparkSession, version: int) -> list[dict]:
        entries = json.loads(storage.read_text(spark, f"{self.manifests}/{version}.json")) if version else []
        # a year of a manifest of former times is in one folder
        return [e if "folders" in e else {"year": e["year"], "folders": [e["folder"]], "keys": [e["keys"]], "buckets": e["buckets"]} for e in entries]

    def _latest(self, spark: SparkSession) -> int:
        """The highest version, 0 for no table."""
        return max(self.versions(spark), default=0)

    def manifest(self, spark: SparkSession, version: int | None = None) -> dict[int | None, list[str]]:
        """Year -> folders below ``path``; the latest version unless given, empty for no table."""
        version = self._latest(spark) if version is None else version
        return {e["year"]: e["folders"] for e in self._entries(spark, version)}

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    def read(self, spark: SparkSession, version: int | None = None, years=None) -> DataFrame:
        """The table (of a version, of some ``years``) as one scan of the folders that its manifest names."""
        return self._scan(spark, [f for y, folders in self.manifest(spark, version).items() if years is None or y in years for f in folders])

    def _scan(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], FACT_TABLE_SCHEMA)
        schema = T.StructType([*FACT_TABLE_SCHEMA.fields, T.StructField(_RUN, T.StringType(), True)])
        paths = [f"{self.path}/{f}" for f in folders]
        return spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).drop(_RUN)

    def read_for(self, spark: SparkSession, teams=(), players=(), version: int | None = None) -> DataFrame:
        """Rows of the given teams and players (all, where none are given), from the files whose bounds they are in."""
        asked = {"TEAM_ID": list(teams), "PLAYER_ID": list(players)}
        files = self.files_for(spark, asked, version)
        rows = self._scan(spark, files)
        for c, values in asked.items():
            if values:
                rows = rows.where(F.col(c).isin(values))
        return rows

    def files_for(self, spark: SparkSession, asked: dict, version: int | None = None) -> list[str]:
        """Files below ``path`` that may have rows with one of the ``asked`` values of each column.

        The bounds of all files are a table beside the rows; only the names of
        the files to be read come back.
        """
        folders = [f for of_year in self.manifest(spark, version).values() for f in of_year]
        if not folders:
            return []
        runs = sorted({f.split("/")[1] for f in folders})
        bounds = spark.read.schema(_BOUNDS).parquet(*[f"{self.path}/bounds/{r}" for r in runs])
        near = F.substring_index("file", "/", 3).isin(folders)
        for c, values in asked.items():
            if values:
                near = near & _any_between(values, F.col(f"least_{c}"), F.col(f"most_{c}"))
        return sorted(r["file"] for r in bounds.where(near).select("file").collect())

    def years(self, spark: SparkSession) -> list:
        """Years present (None for rows without a GAME_DATE)."""
        return sorted(self.manifest(spark), key=lambda y: (y is None, y))

    def between_dates(self, spark: SparkSession, start, end) -> DataFrame:
        """Rows with start <= GAME_DATE <= end, pruned to the matching year folders.

        A GAME_DATE filter alone does not prune partitions; only the year
        range's folders are listed and read.
        """
        s = dt.date.fromisoformat(start) if isinstance(start, str) else start
        e = dt.date.fromisoformat(end) if isinstance(end, str) else end
        rows = self.read(spark, years={y for y in self.years(spark) if y is not None and s.year <= y <= e.year})
        return rows.where(F.col(YEAR).between(s.year, e.year) & F.col("GAME_DATE").between(F.lit(s), F.lit(e)))

    def changes(self, spark: SparkSession, since: int, until: int | None = None) -> tuple[DataFrame, set]:
        """Rows of the folders that one of two versions has and the other has not, and the years of these.

        Old rows have ``_SIGN`` -1, new ones 1: what is added up over them is the
        difference of the versions. Rows that a rewrite kept are on both sides;
        of a year that only got rows, these alone are read.
        """
        old, new = self.manifest(spark, since), self.manifest(spark, until)
        years = {y for y in set(old) | set(new) if old.get(y) != new.get(y)}
        sides = [
            self._scan(spark, [f for y in years for f in m.get(y, []) if f not in other.get(y, [])]).withColumn("_SIGN", F.lit(sign))
            for m, other, sign in ((old, new, -1), (new, old, 1))
        ]
        return union_all(*sides), years

    def difference(self, spark: SparkSession, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows added, rows removed) between two versions, whatever their load stamp; a changed row is in both."""
        changes, _ = self.changes(spark, since, until)
        columns = [c for c in changes.columns if c not in ("_SIGN", "LAST_UPDATE")]
        net = changes.groupBy(*columns).agg(F.sum("_SIGN").alias("_n")).where("_n != 0")
        return tuple(
            net.where(F.col("_n") * sign > 0).select(*columns, F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int"))).alias("_again")).drop("_again")
            for sign in (1, -1)
        )

    def keys(self, spark: SparkSession, version: int | None = None) -> tuple[DataFrame, str | None]:
        """The table's keys with their years, as a bucketed scan, and the name of its catalog entry (to be dropped).

        Spark knows buckets by the catalog only, so the folders that the
        manifest names are entered as partitions of an external table of this
        session; dropping it leaves them as they are.
        """
        version = self._latest(spark) if version is None else version
        entries = self._entries(spark, version)
        if not entries:
            return spark.createDataFrame([], T.StructType([*_KEY_SCHEMA.fields, T.StructField(YEAR, schemas.LONG, True)])), None
        name = f"courtline_keys_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _KEY_SCHEMA.fields)
        by = ", ".join(KEYS)
        # one partition column, a number of the folder: null years are partitions like others
        spark.sql(
            f"CREATE TABLE {name} ({columns}, AT INT) USING parquet PARTITIONED BY (AT) "
            f"CLUSTERED BY ({by}) INTO {entries[0]['buckets']} BUCKETS LOCATION '{_quoted(self.path)}/keys'"
        )
        folders = [(e["year"], k) for e in entries for k in e["keys"]]
        parts = " ".join(f"PARTITION (AT = {i}) LOCATION '{_quoted(self.path)}/{_quoted(k)}'" for i, (_, k) in enumerate(folders))
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
        years = F.element_at(F.array(*[F.lit(y).cast("bigint") for y, _ in folders]), F.col("AT") + 1)
        return spark.table(name).select(*KEYS, years.alias(YEAR)), name

    # ------------------------------------------------------------- write ---

    def merge(
        self,
        spark: SparkSession,
        current: DataFrame,
        past: DataFrame,
        *,
        full_refresh: bool = False,
        on_duplicate: str = "error",
        attempts: int = 5,
    ) -> MergeResult:
        """Create, fully refresh, or incrementally merge the table.

        ``current`` and ``past`` are conformed fact frames (31 columns).

        The target's keys are joined once, with the distinct incoming keys;
        the answer (which keys the target has, in which years) is stored and
        serves for the past rows to insert, the years to rewrite and the
        target rows to replace. Where another run's commit changed what this
        one read, it is made anew, ``attempts`` times at most.
        """
        for made in range(attempts):
            with session.for_writes(spark):
                out = self._merge_once(spark, current, past, full_refresh, on_duplicate)
            if out is not None:
                out.conflicts += made
                return out
        raise ConcurrentRuns(f"{attempts} runs on {self.path} met commits of other runs; run again")

    def _merge_once(self, spark: SparkSession, current: DataFrame, past: DataFrame, full_refresh: bool, on_duplicate: str) -> MergeResult | None:
        base = self._latest(spark)
        old = {e["year"]: e for e in self._entries(spark, base)}
        incremental = not full_refresh and bool(old)
        scratch: list[str] = []
        entered: list[str] = []

        def hold(again: DataFrame) -> DataFrame:
            again, p = _stage(spark, again, "repeated-keys")
            scratch.append(p)
            return again

        try:
            moved: set = set()
            if incremental:
                asked = current.select(*KEYS).union(past.select(*KEYS)).distinct()
                target, name = self.keys(spark, base)
                entered.append(name)
                met, p = _stage(spark, target.join(asked, KEYS, "left_semi"), "met-keys")
                scratch.append(p)
                fresh = past.join(met.select(*KEYS), KEYS, "left_anti").select(*current.columns)
                incoming = with_year(union_all(current, fresh))
            else:
                incoming = with_year(union_all(current, past.select(*current.columns)))
            # Incoming rows come out of casts and joins and are read several times below.
            incoming, p = _stage(spark, incoming, "incoming")
            scratch.append(p)
            # what this run asked the target for: keys that it has, and those of the rows that come in
            asked = met.select(*KEYS).union(incoming.select(*KEYS)) if incremental else None
            try:
                incoming, rep = validate_keys(incoming, on_duplicate=on_duplicate, hold=hold)
            except NullKeyError as e:
                # Keep the rejected rows where they outlive this run's scratch.
                e.rejects.write.mode("overwrite").parquet(self.rejects_path)
                e.rejects = spark.read.parquet(self.rejects_path)
                raise
            n_in = rep["rows"] - rep["dup_rows"]

            # Distinct years: bounded by the calendar, a few values.
            in_years = {r[0] for r in incoming.select(YEAR).distinct().collect()}
            source = incoming
            grown: set = set()
            if incremental:
                # Target rows that are replaced: past rows come in where the target has not their key, so the current ones have it.
                replaced, p = _stage(spark, met.join(incoming.select(*KEYS), KEYS, "left_semi"), "replaced-keys")
                scratch.append(p)
                # Their years (a game may move to another year).
                moved = {r[0] for r in replaced.select(YEAR).distinct().collect()}
                grown = {y for y in in_years - moved if y in old and len(old[y]["folders"]) < MAX_FOLDERS}
                kept = self._kept(spark, old, in_years - grown, moved, replaced)
                source = kept.unionByName(incoming.select(*kept.columns))
            touched = in_years | moved if incremental else in_years | set(old)
            own = self._write(spark, source, base, _buckets(spark, old, self.buckets)) if touched else {}
            # others' commits leave the touched years as they were, or this run is made anew
            own |= {y: own[y] | {f: old[y][f] + own[y][f] for f in ("folders", "keys")} for y in grown}

            version, now, conflicts = base, old, 0
            while True:
                kept_years = {y: e for y, e in now.items() if y not in touched} if incremental else {}
                entries = sorted((kept_years | own).values(), key=lambda e: (e["year"] is None, e["year"]))
                # a manifest that was committed and vacuumed since must not be written again
                if self._latest(spark) == version and storage.write_text(spark, f"{self.manifests}/{version + 1}.json", json.dumps(entries)):
                    break
                conflicts += 1
                version = self._latest(spark)
                now = {e["year"]: e for e in self._entries(spark, version)}
                if conflicts > 20:
                    return None
                if not full_refresh and not (incremental and self._untouched(spark, old, now, touched, asked)):
                    return None  # a full refresh replaces whatever there is
            dropped = sorted((y for y in now if y not in kept_years and y not in own), key=lambda y: (y is None, y))
            written = sorted(own, key=lambda y: (y is None, y))
            mode = "incremental" if incremental else "full_refresh" if old else "create"
            return MergeResult(self.path, mode, n_in, written, dropped, version + 1, conflicts)
        finally:
            for name in entered:
                if name:
                    spark.sql(f"DROP TABLE IF EXISTS {name}")
            for p in scratch:
                storage.delete(spark, p)

    def _kept(self, spark: SparkSession, old: dict, in_years: set, moved: set, replaced: DataFrame) -> DataFrame:
        """Rows of the years to be written anew that stay. Years without a replaced key (not in ``moved``) are not joined with these."""
        whole = self._scan(spark, [f for y, e in old.items() if y in in_years - moved for f in e["folders"]])
        if not moved:
            return whole
        part = self._scan(spark, [f for y, e in old.items() if y in moved for f in e["folders"]])
        return whole.unionByName(part.join(replaced.select(*KEYS), KEYS, "left_anti").select(*whole.columns))

    def _write(self, spark: SparkSession, source: DataFrame, base: int, buckets: int) -> dict:
        """Write rows and keys of the touched years into folders of this run's own: year -> manifest entry."""
        run = f"{base + 1}-{uuid.uuid4().hex}"
        rows, keys = f"data/{_RUN}={run}", f"keys/{_RUN}={run}"
        (
            clustered(source)
            .write.mode("errorifexists")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .option("compression", session.codec(spark))
            .partitionBy(YEAR)
            .parquet(f"{self.path}/{rows}")
        )
        written = self._scan_run(spark, rows)
        relative = F.concat(F.lit(rows), F.regexp_extract("file", f"{re.escape(run)}(/.*)$", 1))
        bounds = [f(c).alias(f"{n}_{c}") for c in schemas.CLUSTER_COLUMNS for n, f in (("least", F.min), ("most", F.max))]
        bounds = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds).withColumn("file", relative)
        bounds.write.parquet(f"{self.path}/bounds/{_RUN}={run}")
        written = written.select(*KEYS, YEAR)
        name = f"courtline_keys_{uuid.uuid4().hex}"
        try:
            (
                written.repartition(buckets, *KEYS)
                .write.partitionBy(YEAR)
                .bucketBy(buckets, *KEYS)
                .option("path", f"{self.path}/{keys}")
                .option("compression", session.codec(spark))
                .format("parquet")
                .saveAsTable(name)
            )
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        out = {}
        for y in _years_at(spark, f"{self.path}/{rows}"):
            year = f"{YEAR}={_NULL_FOLDER if y is None else y}"
            out[y] = {"year": y, "folders": [f"{rows}/{year}"], "keys": [f"{keys}/{year}"], "buckets": buckets}
        return out

    def _scan_run(self, spark: SparkSession, rows: str) -> DataFrame:
        return spark.read.schema(FACT_TABLE_SCHEMA).parquet(f"{self.path}/{rows}")

    def _untouched(self, spark: SparkSession, old: dict, newer: dict, touched: set, asked: DataFrame) -> bool:
        """Whether what others changed since ``old`` has no part in this run: neither its years nor its keys."""
        changed = {y for y in set(old) | set(newer) if old.get(y) != newer.get(y)}
        if changed & touched:
            return False
        folders = [k for m in (old, newer) for y in changed if y in m for k in m[y]["keys"]]
        if not folders:
            return True
        there = spark.read.schema(_KEY_SCHEMA).parquet(*[f"{self.path}/{f}" for f in folders])
        return there.join(asked, KEYS, "left_semi").isEmpty()

    def vacuum(self, spark: SparkSession, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Remove data that none of the last ``keep`` versions names, and older manifests; returns the removed runs.

        What is younger than ``older_than_hours`` stays: folders may be those of
        a run that has not committed yet, manifests tell such a run that
        others have, and someone may be reading.
        """
        found = self.versions(spark)
        if not found or keep < 1:
            return []
        before = time.time() - older_than_hours * 3600
        old = [v for v in found[:-keep] if storage.modified(spark, f"{self.manifests}/{v}.json") <= before]
        named = {re.search(f"{_RUN}=([^/]+)", f)[1] for v in found if v not in old for e in self._entries(spark, v) for f in e["folders"]}
        for v in old:
            storage.delete(spark, f"{self.manifests}/{v}.json")
        gone = []
        for kind in ("data", "keys", "bounds"):
            for run in storage.list_partition_values(spark, f"{self.path}/{kind}", _RUN):
                folder = f"{self.path}/{kind}/{_RUN}={run}"
                if run not in named and storage.modified(spark, folder) <= before:
                    storage.delete(spark, folder)
                    if run not in gone:
                        gone.append(run)
        return gone


# Folder name Spark gives the partition of a null value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _any_between(values: list, least: Column, most: Column) -> Column:
    return F.exists(F.array(*[F.lit(v) for v in values]), lambda v: v.between(least, most))


def _buckets(spark: SparkSession, entries: dict, given: int | None) -> int:
    """That of the table, else the given number, else the session's shuffle partitions."""
    of_table = next((e["buckets"] for e in entries.values()), None)
    return of_table or given or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _years_at(spark: SparkSession, path: str) -> set:
    return {
        None if v == _NULL_FOLDER else int(v)
        for v in storage.list_partition_values(spark, path, YEAR)
    }


def _stage(spark: SparkSession, df: DataFrame, name: str):
    """Write ``df`` to the shared checkpoint folder and read it back."""
    path = session.scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", session.codec(spark)).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
