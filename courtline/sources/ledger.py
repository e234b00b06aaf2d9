"""Landing of seasons by a ledger: only seasons whose extracts are new or changed are read and written.

A landing keeps one folder for each season and a manifest that names, for each,
the folder and the extract files it was made from (name, length, time of change). The
next landing lists the extracts, which reads no data, and lands the seasons
whose files differ; the others stay where they are, seasons without files
go. As in the fact table, folders are written by a run of its own and counted in by the
manifest alone, so a landing that fails leaves the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.sources import landed, storage

_RUN = "RUN"


class LandedMeanwhile(RuntimeError):
    """Another landing was committed first."""


@dataclass
class LedgerResult:
    version: int
    landed: list = field(default_factory=list)
    kept: list = field(default_factory=list)
    dropped: list = field(default_factory=list)
    #: (partition values, file, error) of files that can't be read; their seasons stay as they were.
    failed: list = field(default_factory=list)


class LandedSeasons:
    """Landed seasons at ``path``: ``seasons/RUN=<run>/SEASON=<season>`` and ``_ledger/<n>.json``."""

    def __init__(self, path: str, partition_cols=("SEASON", "GAME_TYPE")):
        self.path = path.rstrip("/")
        self.partition_cols = list(partition_cols)
        self.ledger = f"{self.path}/_ledger"

    def _latest(self, spark: SparkSession) -> tuple[int, dict]:
        names = storage.list_names(spark, self.ledger)
        n = max((int(x[:-5]) for x in names if x.endswith(".json") and x[:-5].isdigit()), default=0)
        entries = json.loads(storage.read_text(spark, f"{self.ledger}/{n}.json")) if n else []
        return n, {e["season"]: e for e in entries}

    def read(self, spark: SparkSession) -> DataFrame:
        """All landed seasons by name, whatever columns each was landed with."""
        folders = {e["folder"] for e in self._latest(spark)[1].values() if e["folder"]}
        runs = {f.split("/")[0].partition("=")[2] for f in folders}
        named = lambda v: f"{_RUN}={v[0]}/SEASON={v[1]}" in folders
        return landed.read_laid_out(spark, f"{self.path}/seasons", [_RUN, "SEASON"], keep=lambda v: v[0] in runs and named(v)).drop(_RUN)

    def _files(self, spark: SparkSession, root: str) -> dict:
        """Season -> its extract files as (path below root, length, time of change)."""
        out: dict = {}
        for values in storage.leaf_folders(spark, root, self.partition_cols):
            below = "/".join(f"{c}={v}" for c, v in zip(self.partition_cols, values, strict=True))
            season = None if values[0] == landed.NULL_FOLDER else unquote(values[0])
            for name, length, changed in storage.list_file_states(spark, f"{root.rstrip('/')}/{below}"):
                out.setdefault(season, []).append([f"{below}/{name}", length, changed])
        return out

    def land(self, spark: SparkSession, extracts_root: str, prepare: Callable[[DataFrame], DataFrame], made_by: str, contract=None, seasons=None) -> LedgerResult:
        """Land the seasons (all, or the given ones) whose files, or whose ``made_by``, differ from the ledger's.

        ``made_by`` stands for what ``prepare`` does beside the extracts (the
        cutoff): seasons landed under another one are landed again. A season
        that cannot be read keeps its last landing.
        """
        version, old = self._latest(spark)
        there = {s: f for s, f in self._files(spark, extracts_root).items() if seasons is None or s is None or s in seasons}
        stale = {s for s, files in there.items() if s not in old or old[s]["files"] != files or old[s]["made_by"] != made_by}
        failed: list = []
        new: dict = {}
        if stale:
            rows = landed.read_laid_out(spark, extracts_root, self.partition_cols, contract, keep=lambda v: v[0] in stale, failed=failed)
            unread = {values[0] for values, _, _ in failed}
            run = f"{version + 1}-{uuid.uuid4().hex}"
            bad = F.coalesce(F.col("SEASON").isin([s for s in unread if s is not None]), F.lit(None in unread))
            out = prepare(rows.where(~bad) if unread else rows)
            out.write.partitionBy("SEASON").parquet(f"{self.path}/seasons/{_RUN}={run}")
            written = set(storage.list_partition_values(spark, f"{self.path}/seasons/{_RUN}={run}", "SEASON"))
            for s in stale - unread:
                name = next((w for w in written if (None if w == landed.NULL_FOLDER else unquote(w)) == s), None)
                # a season without rows on this side is landed as well, without a folder
                folder = f"{_RUN}={run}/SEASON={s}" if name is not None else None
                new[s] = {"season": s, "folder": folder, "files": there[s], "made_by": made_by}
        else:
            unread = set()
        kept = {s: e for s, e in old.items() if s in there and s not in new}
        entries = sorted((kept | new).values(), key=lambda e: (e["season"] is None, e["season"] or ""))
        if new or len(kept) != len(old):
            if not storage.write_text(spark, f"{self.ledger}/{version + 1}.json", json.dumps(entries)):
                raise LandedMeanwhile(f"version {version + 1} of {self.path} was landed meanwhile; land again")
            version += 1
        order = lambda x: sorted(x, key=lambda s: (s is None, s or ""))
        return LedgerResult(version, order(new), order(kept), order(set(old) - set(there)), failed)

