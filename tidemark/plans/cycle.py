"""One polling cycle over any number of tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_WATERMARK, TableConfig, table_config
from tidemark.operators.watermark import lookup_watermarks
from tidemark.sinks.targets import TargetStore
from tidemark.sources.change_log import changes_after, check_schema

T = TypeVar("T")

# A change log in stage form, or a function that gives the changes after a mark.
ChangeLog = DataFrame | Callable[[datetime], DataFrame]


def run_cycle(
    store: TargetStore,
    logs: Mapping[str, ChangeLog],
    tables: Mapping[str, TableConfig] | None = None,
    default: datetime = DEFAULT_WATERMARK,
    exact: bool = False,
    no_reread: bool = False,
) -> dict[str, int]:
    """Read each table's new changes past its mark and apply them.

    Tables do not depend on each other, so their jobs are submitted together and
    share the cluster.  Returns the number of staged rows per table.

    A mark cut to milliseconds reads the rows of the last partial millisecond again.
    With ``no_reread`` those that were applied are left out, known by commit time,
    sequence value and operation, so that no change is applied twice and one that comes
    late with the time of the mark is not lost, as it is with ``exact``.
    """
    if exact and no_reread:
        raise ValueError("no_reread needs marks that are cut")
    configs = {name: tables[name] if tables else table_config(name) for name in logs}
    for name, log in logs.items():
        if isinstance(log, DataFrame):
            check_schema(log, configs[name])
    # before the marks: what is committed from here on stops the batch
    states = {name: store.state(config) for name, config in configs.items()}
    names = [config.name for config in configs.values()]
    found = lookup_watermarks(store.registry(), names, default, exact)
    marks = {r["table_name"]: r["last_update"] for r in found.collect()}  # one per table

    def poll(name: str) -> int:
        config, log = configs[name], logs[name]
        mark = marks[config.name]
        state = states[name]
        if no_reread and state.last_update is not None:
            # the whole millisecond, its first moment included, but nothing of the first content
            mark = max(mark - timedelta(microseconds=1), state.edge_after or datetime.min)
        changes = changes_after(log, mark) if isinstance(log, DataFrame) else log(mark)
        changes = check_schema(changes, config)
        if no_reread:
            changes = not_seen(changes, store.seen_at_mark(config, state))
        return store.apply(config, changes, state=state)

    return _side_by_side(store, poll, logs)


def maintain_tables(store: TargetStore, configs: Iterable[TableConfig]) -> None:
    """Compaction and merging of what is due; between cycles, not in them."""
    tables = {config.name: config for config in configs}
    _side_by_side(store, lambda name: store.maintain(tables[name]), tables)


def compact_tables(store: TargetStore, configs: Iterable[TableConfig]) -> None:
    """Rewrite whatever open batches touch, due or not."""
    tables = {config.name: config for config in configs}
    _side_by_side(store, lambda name: store.compact(tables[name]), tables)


def _side_by_side(store: TargetStore, job: Callable[[str], T], names: Iterable[str]) -> dict[str, T]:
    names = list(names)
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        jobs = {n: pool.submit(inheritable_thread_target(store.spark)(job), n) for n in names}
        return {name: future.result() for name, future in jobs.items()}


def not_seen(changes: DataFrame, seen: DataFrame) -> DataFrame:
    """Changes that are not among the seen ones, by ``(start_lsn, seqval, operation)``.

    Only changes at or next to the mark can be, but a bulk load may put very many there:
    the two sides meet in a plain join, which Spark broadcasts where one is small.
    """
    same = [changes[c].eqNullSafe(seen[c]) for c in seen.columns]
    return changes.join(seen, reduce(lambda a, b: a & b, same), "left_anti")


def summarize(store: TargetStore, configs: list[TableConfig]) -> DataFrame:
    """Rows, deleted rows, current rows and mark of each table."""
    counts = [
        store.read(t)
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if("is_deleted").alias("n_deleted"),
            # a type-1 table holds nothing but current rows
            (F.count_if("is_current") if t.versioned else F.count("*")).alias("n_current"),
        )
        .withColumn("table_name", F.lit(t.name))
        for t in configs
    ]
    summary = counts[0]
    for other in counts[1:]:
        summary = summary.unionByName(other)
    return summary.join(store.registry(), "table_name", "left").select(
        "table_name", "n_rows", "n_deleted", "n_current", "last_update"
    )
