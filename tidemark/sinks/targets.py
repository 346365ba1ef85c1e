"""Target tables as bucketed snapshots plus the batches applied since.

    snapshots/<table>/batch_id=<n>/attempt=<a>/bucket=<b>/   a bucket's rows as of batch n
    batches/<table>/batch_id=<n>/attempt=<a>/                the staged changes of batch n
    commits/<table>/<number>.json                            one small file per commit

Applying a batch writes the batch and a commit, so a poll costs as much as its
changes, not as much as the target.  Reading replays the batches over the snapshot as
one join; while they are few they are broadcast and the snapshot is not shuffled.

A snapshot is dealt into buckets by key.  Compaction, which is no part of a poll,
rewrites the buckets in which the open batches hold a given share of the rows; the
others stay as they are and go on waiting, so what is written follows the batches and
not the target.  A bucket that no open batch touches moves on without being written.

Many small open batches are merged into one folder, so their number stays bounded too.

The commit holds the new watermark and names the folders that count, so rows and
watermark become visible together, when that one file appears.  Its number must be
new: of two writers that start from one state the second stops, and loses nothing but
its own attempt.  Folders that no commit names are never read; ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import TableConfig
from tidemark.functions import floor_ms, ntz, row_bytes
from tidemark.operators import type1
from tidemark.operators.joins import BROADCAST_BYTES, fits_broadcast
from tidemark.operators.replay import replay
from tidemark.operators.watermark import REGISTRY_SCHEMA
from tidemark.sinks.files import Folder
from tidemark.sinks.stage import write_stage

KEPT_COMMITS = 16
COMPACT_SHARE = 0.2
MERGE_BATCHES = 50  # folders of open batches that are merged into one
BUCKET_BYTES = 256 * 1024 * 1024
MAX_BUCKETS = 4_096
SPLIT_BUCKETS = 4  # buckets that one may become without its rows being gathered
SINGLE, MERGED = "a", "m"  # first letters of attempts
BATCH_NO = T.StructField("batch_no", T.LongType())
TIMES = ("last_update", "source_mark", "edge_after")


class CommitConflict(RuntimeError):
    """Another writer committed since the state was read."""


@dataclass(frozen=True)
class TableState:
    commit_id: int = 0
    batch_id: int = 0
    last_update: datetime | None = None
    source: str | None = None
    source_batch: int | None = None
    source_mark: datetime | None = None  # where the source took over
    batches: dict[str, str] = field(default_factory=dict)  # attempts by batch
    batches_bytes: int = 0
    edge_batch: int = 1  # first batch that may hold rows of the mark's millisecond
    edge_after: datetime | None = None  # that far the first content has them all
    levels: list[int] = field(default_factory=list)  # by bucket: batch up to which it is written
    folders: list[str] = field(default_factory=list)  # by bucket; empty without rows
    snapshot_bytes: int = 0

    @property
    def snapshot_id(self) -> int | None:
        """Batch up to which every bucket is written."""
        return min(self.levels) if self.levels else None

    @property
    def open_batches(self) -> range:
        """Batches that are not part of every bucket."""
        return range((self.snapshot_id or 0) + 1, self.batch_id + 1)

    def to_json(self) -> str:
        known = asdict(self)
        for name in TIMES:
            known[name] = known[name] and known[name].isoformat(sep=" ")
        return json.dumps(known)

    @classmethod
    def from_json(cls, text: str) -> TableState:
        known = json.loads(text)
        for name in TIMES:
            known[name] = known[name] and datetime.fromisoformat(known[name])
        return cls(**known)


class TargetStore:
    """``compact_share`` and ``compact_batches``, if given, have every batch followed by a
    compaction that is due by them: the open batches are too large to broadcast and
    hold that share of the snapshot's size, or there are that many of them.  By
    default none is, and ``maintain`` is called between polls."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        compact_share: float | None = None,
        compact_batches: int | None = None,
        bucket_bytes: int = BUCKET_BYTES,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.compact_share, self.compact_batches = compact_share, compact_batches
        self.bucket_bytes = bucket_bytes
        self.files = Folder(spark, self.root)
        self.files.make("commits")

    # -- commits ---------------------------------------------------------

    def _commits(self, table_name: str) -> list[str]:
        """The kept commits, oldest first."""
        names = self.files.names(f"commits/{table_name}")
        return [f"commits/{table_name}/{name}" for name in names]

    def _last(self, table_name: str) -> TableState:
        commits = self._commits(table_name)
        return TableState.from_json(self.files.read(commits[-1])) if commits else TableState()

    def state(self, table: TableConfig) -> TableState:
        return self._last(table.name)

    def registry(self) -> DataFrame:
        """Watermark of every table: ``(table_name, last_update)``."""
        marks = [(name, self._last(name).last_update) for name in self.files.names("commits")]
        return self.spark.createDataFrame(marks, REGISTRY_SCHEMA)

    def _commit(self, table: TableConfig, state: TableState) -> TableState:
        state = replace(state, commit_id=state.commit_id + 1)
        path = f"commits/{table.name}/{state.commit_id:012}.json"
        if not self.files.create(path, state.to_json()):
            raise CommitConflict(f"{table.name}: commit {state.commit_id} exists already")
        for old in self._commits(table.name)[:-KEPT_COMMITS]:
            self.files.delete(old)
        return state

    # -- rows ------------------------------------------------------------

    def _batch_path(self, table: TableConfig, batch_id: int) -> str:
        return f"{self.root}/batches/{table.name}/batch_id={batch_id}"

    def _read_batches(self, table: TableConfig, state: TableState, first: int) -> DataFrame:
        """Batches from the first one on; merged ones carry their rows' numbers."""
        paths = [
            f"{self._batch_path(table, n)}/attempt={state.batches[str(n)]}"
            for n in sorted(map(int, state.batches))
            if n >= first
        ]
        number = F.coalesce("batch_no", F.col("batch_id").cast("long"))
        return (
            self.spark.read.schema(T.StructType([*table.stage_schema, BATCH_NO]))
            .option("basePath", f"{self.root}/batches/{table.name}")
            .parquet(*paths)
            .select(*table.stage_schema.fieldNames(), number.alias("batch_no"))
            .filter(F.col("batch_no") >= first)
        )

    def _bucket(self, table: TableConfig, buckets: int) -> Column:
        return F.pmod(F.xxhash64(table.key), F.lit(buckets)).cast("int")

    def _read_buckets(self, table: TableConfig, folders: list[str]) -> DataFrame:
        paths = [f"{self.root}/{folder}" for folder in folders if folder]
        if not paths:
            return self.spark.createDataFrame([], table.target_schema)
        return self.spark.read.schema(table.target_schema).parquet(*paths)

    def read(
        self,
        table: TableConfig,
        state: TableState | None = None,
        buckets: list[int] | None = None,
    ) -> DataFrame:
        """The table's rows after all committed batches, or those of some buckets."""
        state = state or self.state(table)
        rows, history = self._parts(table, state, buckets)
        if history is None:
            return rows
        if not table.versioned and not any(state.folders):
            return type1.apply_to_none(rows, history, table)
        # broadcasting spares a snapshot from the shuffle; without one it gains nothing
        spared = table.versioned or len(state.levels) > 0
        return replay(rows, history, table, state.batches_bytes if spared else None)

    def _parts(
        self, table: TableConfig, state: TableState, buckets: list[int] | None
    ) -> tuple[DataFrame, DataFrame | None]:
        """The snapshot's rows, and the open changes if there are any."""
        levels, count = state.levels, len(state.levels)
        folders = state.folders if buckets is None else [state.folders[b] for b in buckets]
        rows = self._read_buckets(table, folders)
        if not state.open_batches:
            return rows, None
        history = self._read_batches(table, state, state.open_batches[0])
        if buckets is not None and len(buckets) < count:
            history = history.filter(self._bucket(table, count).isin(buckets))
        if len(set(levels)) > 1:  # some buckets are further on
            level = F.get(F.array(*map(F.lit, levels)), self._bucket(table, count))
            history = history.filter(F.col(table.key).isNull() | (F.col("batch_no") > level))
        return rows, history

    def _read_apart(
        self, table: TableConfig, state: TableState, buckets: list[int] | None = None
    ) -> tuple[DataFrame, DataFrame | None]:
        """``read`` in two parts: rows that may go to any bucket, and rows that no open
        change can touch, which are read bucket by bucket."""
        small = fits_broadcast(state.batches_bytes)
        if table.versioned or small or not any(state.folders) or not state.open_batches:
            return self.read(table, state, buckets), None
        return type1.apply_history_apart(*self._parts(table, state, buckets), table)

    def seen_at_mark(self, table: TableConfig, state: TableState | None = None) -> DataFrame:
        """(start_lsn, seqval, operation) of the applied rows in the mark's millisecond, or
        after its begin."""
        state = state or self.state(table)
        columns = ["start_lsn", "seqval", "operation"]
        if state.last_update is None or not state.batch_id:
            empty = self.spark.createDataFrame([], table.stage_schema)
            return empty.select(columns)
        last = self._read_batches(table, state, state.edge_batch)
        return last.filter(F.col("start_lsn") >= ntz(floor_ms(state.last_update))).select(columns)

    def _write_buckets(
        self,
        rows: DataFrame,
        table: TableConfig,
        batch_id: int,
        buckets: int,
        placed: DataFrame | None = None,
    ) -> tuple[dict[int, str], int]:
        """Write rows by bucket; the folders of those that have any, and their size.

        One bucket needs no shuffle: after a broadcast merge the files follow the scan's
        splits, and after a shuffled one adaptive execution has sized the partitions.
        More of them are gathered first, and adaptive execution splits large ones; only
        ``placed`` rows, which come bucket by bucket, are written from where they are read.
        """
        path = f"snapshots/{table.name}/batch_id={batch_id}/attempt={SINGLE}{uuid.uuid4().hex}"
        seen = Observation()
        names = table.target_schema.fieldNames()
        parts = [part.select(*names) for part in (rows, placed) if part is not None]
        if buckets > 1:
            parts = [part.withColumn("bucket", self._bucket(table, buckets)) for part in parts]
            parts[0] = parts[0].hint("rebalance", "bucket")
        rows = reduce(DataFrame.unionByName, parts).observe(
            seen, F.sum(row_bytes(table.target_schema)).alias("size_bytes")
        )
        if buckets == 1:
            rows.write.parquet(f"{self.root}/{path}/bucket=0")
        else:
            rows.write.partitionBy("bucket").parquet(f"{self.root}/{path}")
        names = self.files.names(path)
        written = {int(name.partition("=")[2]): f"{path}/{name}" for name in names}
        return written, seen.get["size_bytes"] or 0

    # -- operations ------------------------------------------------------

    def seed(
        self, table: TableConfig, rows: DataFrame, last_update: datetime | None = None
    ) -> None:
        """First content of a table."""
        if self.state(table).commit_id:
            raise ValueError(f"{table.name} already has content")
        written, size = self._write_buckets(rows, table, 0, 1)
        self._commit(
            table,
            TableState(
                last_update=last_update,
                edge_after=last_update,
                levels=[0],
                folders=[written.get(0, "")],
                snapshot_bytes=size,
            ),
        )

    def apply(
        self,
        table: TableConfig,
        batch: DataFrame,
        source: str | None = None,
        source_batch: int | None = None,
        source_mark: datetime | None = None,
        state: TableState | None = None,
    ) -> int:
        """Add a batch to the table; returns the number of its rows.

        A batch that a source delivers again after its commit is skipped.  A
        batch that died before its commit starts over under the same number.  An
        empty batch changes neither rows nor mark.  ``state`` is the one that the batch
        was read from, by default the last; a commit since then stops the batch.

        A source is a stream with progress of its own.  Its mark is where it took over;
        a batch of another origin in between moves it on, as that one read from the
        table's mark.  A late batch of a source does not move the table's mark back.
        """
        state = state or self.state(table)
        if source is not None and source == state.source and source_batch <= state.source_batch:
            return 0
        batch_id, attempt = state.batch_id + 1, f"{SINGLE}{uuid.uuid4().hex}"
        staged = write_stage(batch, f"{self._batch_path(table, batch_id)}/attempt={attempt}", table)
        if staged.n_rows == 0:
            return 0
        mark = staged.last_update
        if source is not None:
            mark = max(t for t in (mark, state.last_update) if t is not None)
            state = replace(
                state, source=source, source_batch=source_batch, source_mark=source_mark
            )
        elif state.source is not None:
            state = replace(state, source_mark=mark)
        before = state.last_update
        same_edge = before is not None and floor_ms(before) == floor_ms(mark)
        edge = state.edge_batch if same_edge else batch_id
        state = self._commit(
            table,
            replace(
                state,
                batch_id=batch_id,
                last_update=mark,
                batches=_kept(state.batches | {str(batch_id): attempt}, state, edge),
                batches_bytes=state.batches_bytes + staged.size_bytes,
                edge_batch=edge,
                edge_after=state.edge_after if same_edge else None,
            ),
        )
        if self.compact_share is not None or self.compact_batches is not None:
            self.maintain(table, state)
        return staged.n_rows

    def maintain(self, table: TableConfig, state: TableState | None = None) -> TableState:
        """Compact or merge what is due; for between polls."""
        state = state or self.state(table)
        share = COMPACT_SHARE if self.compact_share is None else self.compact_share
        if state.batches_bytes > max(BROADCAST_BYTES, share * state.snapshot_bytes):
            return self.compact(table, state, share / 2)
        if self.compact_batches is not None and len(state.open_batches) >= self.compact_batches:
            return self.compact(table, state)
        single = [n for n, attempt in state.batches.items() if attempt[0] != MERGED]
        if len(single) >= MERGE_BATCHES:
            return self._merge(table, state, min(map(int, single)))
        if len(state.batches) - len(single) >= MERGE_BATCHES:
            return self._merge(table, state, _first_kept(state, state.edge_batch))
        return state

    def _merge(self, table: TableConfig, state: TableState, first: int) -> TableState:
        """Write the batches from one on into one folder; changes no row.

        A batch is merged with others of its size, and once more with many merged ones.
        """
        attempt = f"{MERGED}{uuid.uuid4().hex}"
        rows = self._read_batches(table, state, first).hint("rebalance")
        rows.write.parquet(f"{self._batch_path(table, state.batch_id)}/attempt={attempt}")
        batches = {n: old for n, old in state.batches.items() if int(n) < first}
        batches[str(state.batch_id)] = attempt
        return self._commit(table, replace(state, batches=batches))

    def _wanted_buckets(self, state: TableState) -> int:
        """A power of two, which doubles as the table grows."""
        size = state.snapshot_bytes + state.batches_bytes
        wanted = 1
        while wanted < MAX_BUCKETS and wanted * self.bucket_bytes < size:
            wanted *= 2
        return wanted

    def compact(
        self, table: TableConfig, state: TableState | None = None, share: float = 0.0
    ) -> TableState:
        """Rewrite the buckets that open batches touch; changes no row.

        With a ``share``, only buckets in which the open changes are that share of an
        average bucket's size.  The whole table is only written when it gets its
        first snapshot, or has grown to twice as many buckets.
        """
        state = state or self.state(table)
        if not state.open_batches:
            return state
        wanted, count = self._wanted_buckets(state), len(state.levels)
        if wanted > count:
            rows, placed = self.read(table, state), None
            if wanted <= SPLIT_BUCKETS * count:
                rows, placed = self._read_apart(table, state)
            written, size = self._write_buckets(rows, table, state.batch_id, wanted, placed)
            levels = [state.batch_id] * wanted
            folders = [written.get(b, "") for b in range(wanted)]
            rest = 0
        else:
            levels, folders = list(state.levels), list(state.folders)
            changes = self._changes_by_bucket(table, state)
            least = share * state.snapshot_bytes / count
            chosen = sorted(b for b, n in changes.items() if n >= least)
            size = state.snapshot_bytes
            if chosen:
                rows, placed = self._read_apart(table, state, chosen)
                written, new = self._write_buckets(rows, table, state.batch_id, count, placed)
                size += max(0, new - state.snapshot_bytes * len(chosen) // count)
                folders = [written.get(b, "") if b in chosen else folders[b] for b in range(count)]
            waiting = set(changes) - set(chosen)
            levels = [level if b in waiting else state.batch_id for b, level in enumerate(levels)]
            rest = sum(changes[b] for b in waiting)
        state = replace(
            state, levels=levels, folders=folders, batches_bytes=rest, snapshot_bytes=size
        )
        return self._commit(
            table, replace(state, batches=_kept(state.batches, state, state.edge_batch))
        )

    def _changes_by_bucket(self, table: TableConfig, state: TableState) -> dict[int, int]:
        """Size of the open changes of each bucket that has any; MAX_BUCKETS rows at most."""
        count = len(state.levels)
        history = self._read_batches(table, state, state.open_batches[0])
        level = F.get(F.array(*map(F.lit, state.levels)), self._bucket(table, count))
        open_rows = history.filter(F.col(table.key).isNotNull() & (F.col("batch_no") > level))
        sizes = open_rows.groupBy(self._bucket(table, count).alias("bucket")).agg(
            F.sum(row_bytes(table.stage_schema)).alias("size")
        )
        return {row["bucket"]: row["size"] for row in sizes.collect()}

    def vacuum(self, table: TableConfig, older_than_hours: float = 24.0) -> int:
        """Remove folders that none of the kept commits names; returns their number.

        Younger folders stay, as a batch may be about to commit them and a reader may
        still use what the last commit replaced.
        """
        named = set()
        for path in self._commits(table.name):
            state = TableState.from_json(self.files.read(path))
            named |= {
                f"batches/{table.name}/batch_id={n}/attempt={a}" for n, a in state.batches.items()
            }
            named |= set(state.folders)
        found = [
            f"{kind}/{table.name}/{batch}/{attempt}"
            for kind in ("batches", "snapshots")
            for batch in self.files.names(f"{kind}/{table.name}")
            for attempt in self.files.names(f"{kind}/{table.name}/{batch}")
        ]
        buckets = [
            f"{path}/{name}"
            for path in found
            if path.startswith("snapshots")
            for name in self.files.names(path)
        ]
        oldest = time.time() - older_than_hours * 3600
        batches = [path for path in found if path.startswith("batches")]
        gone = [
            path
            for path in batches + buckets
            if path not in named and self.files.modified(path) <= oldest
        ]
        for path in gone:
            self.files.delete(path)
        return len(gone)


def _first_kept(state: TableState, edge: int) -> int:
    return min((state.snapshot_id or 0) + 1, edge)


def _kept(batches: dict[str, str], state: TableState, edge: int) -> dict[str, str]:
    """Batches that are still open, or hold rows at the mark."""
    return {n: a for n, a in batches.items() if int(n) >= _first_kept(state, edge)}
