"""Stage tables: the current batch of a table, or an append-only log of all polls.

Either is a folder of attempts and numbered switch files.  The last switch file names
the attempts that count, so they change all at once, when that file appears, and
a load or a poll that fails changes nothing for readers.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DEFAULT_WATERMARK, TableConfig
from tidemark.functions import floor_ms, row_bytes
from tidemark.sinks.files import Folder
from tidemark.sources.change_log import changes_after, require_keys

KEPT_SWITCHES = 16
MERGE_FOLDERS = 8  # neighbouring folders of about one size that are merged
TIER_BYTES = 1 << 20  # folders up to this size are of the first tier; each next is 8 times that
POLL = T.StructField("poll", T.IntegerType())


class SwitchConflict(RuntimeError):
    """Another writer switched since the stage was read."""


@dataclass(frozen=True)
class StagedBatch:
    """Where a batch was staged, and what was measured while it was written."""

    path: str
    n_rows: int
    last_update: datetime | None
    size_bytes: int


def write_stage(batch: DataFrame, path: str, table: TableConfig) -> StagedBatch:
    """Write a batch to a path that nothing reads yet.

    Row count, newest commit time and size are observed during the write, so
    the batch is read once.  What a write that died left there is replaced.
    """
    seen = Observation()
    (
        require_keys(batch, table)
        .observe(
            seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.max("start_lsn").alias("last_update"),
            F.sum(row_bytes(table.stage_schema)).alias("size_bytes"),
        )
        .write.mode("overwrite")
        .parquet(path)
    )
    found = seen.get
    return StagedBatch(path, found["n_rows"], found["last_update"], found["size_bytes"] or 0)


class _Switch:
    """The numbered files that say what counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def _names(self) -> list[str]:
        return self.folder.names("switch")

    def last(self) -> tuple[int, list[dict]]:
        names = self._names()
        if not names:
            return 0, []
        return int(names[-1].partition(".")[0]), json.loads(self.folder.read(f"switch/{names[-1]}"))

    def turn(self, number: int, folders: list[dict]) -> None:
        """Make folders count, after the switch of that number."""
        text = json.dumps(folders)
        if not self.folder.create(f"switch/{number + 1:012}.json", text):
            raise SwitchConflict(f"{self.folder.root}: switch {number + 1} exists already")
        for old in self._names()[:-KEPT_SWITCHES]:
            self.folder.delete(f"switch/{old}")


def replace_stage(batch: DataFrame, path: str, table: TableConfig) -> StagedBatch:
    """Replace what is staged at a path by the batch, all at once.

    The load before stays for its readers until the next but one.
    """
    switch = _Switch(batch.sparkSession, path)
    number, before = switch.last()
    name = f"load-{uuid.uuid4().hex}"
    staged = write_stage(batch, f"{path}/{name}", table)
    old = before[0].get("before") if before else None
    switch.turn(number, [{"name": name, "before": before[0]["name"] if before else None}])
    if old:
        switch.folder.delete(old)
    return staged


def read_stage(spark: SparkSession, path: str, table: TableConfig) -> DataFrame:
    """The rows of the last whole load; none before the first."""
    _, loads = _Switch(spark, path).last()
    if not loads:
        return spark.createDataFrame([], table.stage_schema)
    return spark.read.schema(table.stage_schema).parquet(f"{path}/{loads[0]['name']}")


@dataclass(frozen=True)
class PollFolder:
    """Rows of the polls ``first`` to ``last``; ``newest`` is their newest commit time."""

    name: str
    first: int
    last: int
    newest: str | None
    size_bytes: int

    @property
    def tier(self) -> int:
        tier, size = 0, TIER_BYTES
        while size < self.size_bytes:
            tier, size = tier + 1, size * 8
        return tier


def _poll_schema(table: TableConfig) -> T.StructType:
    return T.StructType([*table.stage_schema.fields, POLL])


def append_poll(
    spark: SparkSession,
    log_path: str,
    changes: DataFrame | Callable[[datetime], DataFrame],
    table: TableConfig,
    poll: int,
    default: datetime = DEFAULT_WATERMARK,
    exact: bool = False,
) -> None:
    """One poll of the append-only stage: its own newest time is the mark.

    Before-images are kept; ``changes`` may be a function that gives all images after a
    mark.  A poll only looks at earlier polls, so one that is run
    again replaces its rows, unless it was merged with others.  The switch file notes
    each folder's newest time, so a poll reads nothing of what was appended before.
    """
    switch = _Switch(spark, log_path)
    number, found = switch.last()
    folders = [PollFolder(**f) for f in found]
    if any(f.first <= poll <= f.last and f.first < f.last for f in folders):
        raise ValueError(f"poll {poll} is merged with others")
    newest = max((f.newest for f in folders if f.last < poll and f.newest), default=None)
    mark = default if newest is None else datetime.fromisoformat(newest)
    mark = mark if exact else floor_ms(mark)
    rows = changes if isinstance(changes, DataFrame) else changes(mark)
    seen = Observation()
    name = f"poll-{poll}-{uuid.uuid4().hex}"
    (
        changes_after(rows, mark, before_images=True)
        .select(*table.stage_schema.fieldNames(), F.lit(poll).cast("int").alias("poll"))
        .observe(
            seen,
            F.max("start_lsn").alias("newest"),
            F.sum(row_bytes(table.stage_schema)).alias("size_bytes"),
        )
        .write.parquet(f"{log_path}/{name}")
    )
    newest = seen.get["newest"] and seen.get["newest"].isoformat(sep=" ")
    own = PollFolder(name, poll, poll, newest, seen.get["size_bytes"] or 0)
    others = [f for f in folders if f.first != poll]
    kept = sorted([*others, own], key=lambda f: f.first)
    switch.turn(number, [asdict(f) for f in kept])


def merge_polls(spark: SparkSession, log_path: str, table: TableConfig) -> int:
    """Merge neighbouring folders of one size; returns how many were merged.

    Folders are of tiers, each 8 times the size of the one before, and so many of one tier
    become one of the next.  So a row is written once per tier, and the number of
    folders follows the logarithm of the log.  For between polls.
    """
    switch = _Switch(spark, log_path)
    number, found = switch.last()
    folders = [PollFolder(**f) for f in found]
    start = 0
    while start < len(folders):
        end = start
        while end < len(folders) and folders[end].tier == folders[start].tier:
            end += 1
        if end - start >= MERGE_FOLDERS:
            break
        start = end
    else:
        return 0
    run = folders[start:end]
    name = f"merged-{run[0].first}-{run[-1].last}-{uuid.uuid4().hex}"
    _read_folders(spark, log_path, run, table).hint("rebalance").write.parquet(f"{log_path}/{name}")
    merged = PollFolder(
        name,
        run[0].first,
        run[-1].last,
        max((f.newest for f in run if f.newest), default=None),
        sum(f.size_bytes for f in run),
    )
    kept = [*folders[:start], merged, *folders[end:]]
    switch.turn(number, [asdict(f) for f in kept])
    return len(run)


def _read_folders(
    spark: SparkSession, log_path: str, folders: list[PollFolder], table: TableConfig
) -> DataFrame:
    paths = [f"{log_path}/{f.name}" for f in folders]
    return spark.read.schema(_poll_schema(table)).parquet(*paths)


def read_polls(spark: SparkSession, log_path: str, table: TableConfig) -> DataFrame:
    """Stage columns and ``poll`` of all that was appended."""
    _, found = _Switch(spark, log_path).last()
    if not found:
        return spark.createDataFrame([], _poll_schema(table))
    return _read_folders(spark, log_path, [PollFolder(**f) for f in found], table)


def last_poll(spark: SparkSession, log_path: str) -> int:
    """Number of the last poll; 0 before the first."""
    _, found = _Switch(spark, log_path).last()
    return max((folder["last"] for folder in found), default=0)


def remove_unnamed(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> int:
    """Remove attempts that no kept switch file names; returns their number."""
    switch = _Switch(spark, path)
    texts = [switch.folder.read(f"switch/{name}") for name in switch._names()]
    named = {folder["name"] for text in texts for folder in json.loads(text)}
    named |= {f["before"] for text in texts[-1:] for f in json.loads(text) if f.get("before")}
    oldest = time.time() - older_than_hours * 3600
    gone = [
        name
        for name in switch.folder.names("")
        if name not in named and name != "switch" and switch.folder.modified(name) <= oldest
    ]
    for name in gone:
        switch.folder.delete(name)
    return len(gone)
