"""Streams: the same rows as batches, exactly once over restarts."""

from datetime import datetime, timedelta

import pytest
from model import ACCOUNT, DAY, PLACE, change, frame, rows_of

from tidemark.operators.replay import apply_batches
from tidemark.plans.cycle import run_cycle
from tidemark.sinks.targets import TargetStore
from tidemark.streaming.poll import ALL_AVAILABLE, stream_apply, stream_stage, stream_tables

EARLY = datetime(2000, 1, 1)
DELIVERIES = [
    [change(1, 2, 1, "a", 1), change(2, 3, 1, "before", 9), change(3, 4, 1, "b", 2)],
    [change(4, 1, 1, day=2), change(5, 2, 2, "c", 1)],
    [change(6, 2, 1, "d", 0)],
]


@pytest.mark.parametrize("table", [ACCOUNT, PLACE], ids=lambda t: t.name)
def test_stream_equals_batches(spark, tmp_path, table):
    store = TargetStore(spark, f"{tmp_path}/target", compact_batches=2)
    landing, checkpoint = f"{tmp_path}/landing", f"{tmp_path}/checkpoint"
    for rows in DELIVERIES:
        frame(spark, table, rows).repartition(2).write.mode("append").parquet(landing)
        stream_apply(store, landing, table, checkpoint, ALL_AVAILABLE, EARLY).awaitTermination()
    # nothing new: a further run changes nothing
    state = store.state(table)
    stream_apply(store, landing, table, checkpoint, ALL_AVAILABLE, EARLY).awaitTermination()
    assert store.state(table) == state
    assert state.last_update == DAY + timedelta(seconds=6)

    batches = [frame(spark, table, [c for c in b if c[3] != 3]) for b in DELIVERIES]
    empty = spark.createDataFrame([], table.target_schema)
    assert rows_of(store.read(table)) == rows_of(apply_batches(empty, batches, table))


def test_stream_can_run_on_a_timer(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    landing = f"{tmp_path}/landing"
    frame(spark, ACCOUNT, DELIVERIES[0]).write.parquet(landing)
    timer = {"processingTime": "1 second"}
    query = stream_apply(store, landing, ACCOUNT, f"{tmp_path}/checkpoint", timer, EARLY)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows_of(store.read(ACCOUNT)) == [(1, "b", 2, False)]


def test_several_tables_at_once(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target", compact_batches=1)
    tables = [ACCOUNT, PLACE]
    for rows in DELIVERIES:
        for table in tables:
            path = f"{tmp_path}/landing/{table.name}"
            frame(spark, table, rows).write.mode("append").parquet(path)
        for query in stream_tables(
            store, f"{tmp_path}/landing", tables, f"{tmp_path}/checkpoint", ALL_AVAILABLE, EARLY
        ):
            query.awaitTermination()
    assert {store.state(t).snapshot_id for t in tables} == {3}
    assert store.read(PLACE).count() == 4
    assert rows_of(store.read(ACCOUNT)) == [(1, "d", 0, True), (2, "c", 1, False)]


def test_stage_stream_keeps_every_image(spark, tmp_path):
    landing, stage = f"{tmp_path}/landing", f"{tmp_path}/stage"
    for rows in DELIVERIES:
        frame(spark, ACCOUNT, rows).write.mode("append").parquet(landing)
        stream_stage(
            spark, landing, ACCOUNT, stage, f"{tmp_path}/checkpoint", ALL_AVAILABLE
        ).awaitTermination()
    assert spark.read.parquet(stage).count() == sum(map(len, DELIVERIES))


def test_files_can_be_taken_one_by_one(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    landing = f"{tmp_path}/landing"
    for n, rows in enumerate(DELIVERIES):
        path = tmp_path / "landing" / f"delivery={n}"
        frame(spark, ACCOUNT, rows).coalesce(1).write.parquet(str(path))
    stream_apply(
        store,
        f"{landing}/*",
        ACCOUNT,
        f"{tmp_path}/checkpoint",
        ALL_AVAILABLE,
        EARLY,
        maxFilesPerTrigger="1",
    ).awaitTermination()
    assert store.state(ACCOUNT).batch_id == len(DELIVERIES)
    assert rows_of(store.read(ACCOUNT)) == [(1, "d", 0, True), (2, "c", 1, False)]


def versions(store):
    return sorted(r["place_id"] for r in store.read(PLACE).collect())


def stream_over(spark, tmp_path, store, name, *files, **options):
    """A query over files of keys, whose commit times are the keys, one file a trigger."""
    for n, keys in enumerate(files):
        rows = [change(key, 2, key, "v", key) for key in keys]
        path = f"{tmp_path}/{name}/file={n}"
        frame(spark, PLACE, rows).coalesce(1).write.mode("ignore").parquet(path)
    stream_apply(
        store,
        f"{tmp_path}/{name}/*",
        PLACE,
        f"{tmp_path}/checkpoint-{name}",
        ALL_AVAILABLE,
        **{"default": EARLY, "maxFilesPerTrigger": "1"} | options,
    ).awaitTermination()


def cycle_over(spark, store, keys):
    log = frame(spark, PLACE, [change(key, 2, key, "v", key) for key in keys])
    run_cycle(store, {"p": log}, {"p": PLACE}, default=EARLY)


def test_a_stream_after_a_cycle_respects_its_mark_in_every_file(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    cycle_over(spark, store, [8, 9, 10])
    stream_over(spark, tmp_path, store, "s", [9, 10, 11, 12], [8, 9, 10, 13])
    assert versions(store) == [8, 9, 10, 11, 12, 13]
    assert store.state(PLACE).source_mark == DAY + timedelta(seconds=10)


def test_late_files_of_a_stream_are_not_lost(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    cycle_over(spark, store, [3])
    stream_over(spark, tmp_path, store, "s", [8, 9], [4, 5])
    assert versions(store) == [3, 4, 5, 8, 9]
    assert store.state(PLACE).last_update == DAY + timedelta(seconds=9)
    cycle_over(spark, store, [3, 4, 5, 8, 9, 10])
    assert versions(store) == [3, 4, 5, 8, 9, 10]


def test_a_cycle_between_two_runs_of_a_stream(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    stream_over(spark, tmp_path, store, "s", [1, 2])
    cycle_over(spark, store, [1, 2, 3, 4])
    stream_over(spark, tmp_path, store, "s", [1, 2], [3, 4, 5], [2, 6])
    assert versions(store) == [1, 2, 3, 4, 5, 6]


def test_two_streams_take_turns(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    stream_over(spark, tmp_path, store, "a", [1, 2])
    stream_over(spark, tmp_path, store, "b", [1, 2, 3], [4])
    stream_over(spark, tmp_path, store, "a", [1, 2], [3, 4, 5])
    assert versions(store) == [1, 2, 3, 4, 5]


def test_a_stream_starts_past_the_default_mark(spark, tmp_path):
    for exact, expected in ((False, [2, 3]), (True, [3])):
        store = TargetStore(spark, f"{tmp_path}/target-{exact}")
        default = DAY + timedelta(seconds=2, microseconds=-1 + exact)
        stream_over(spark, tmp_path, store, f"s{exact}", [1, 2, 3], default=default, exact=exact)
        assert versions(store) == expected
