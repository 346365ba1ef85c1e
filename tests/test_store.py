"""Target store: what is published when, retries, compaction and cycles."""

from datetime import datetime, timedelta

import pytest
from model import ACCOUNT, DAY, PLACE, change, frame, rows_of, target
from pyspark.sql import functions as F

from tidemark.plans.cycle import run_cycle
from tidemark.sinks.stage import (
    SwitchConflict,
    _Switch,
    append_poll,
    merge_polls,
    read_polls,
    read_stage,
    remove_unnamed,
    replace_stage,
    write_stage,
)
from tidemark.sinks.targets import KEPT_COMMITS, CommitConflict, TargetStore

EARLY = datetime(2000, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return TargetStore(spark, str(tmp_path))


def mark(store, table):
    found = {r["table_name"]: r["last_update"] for r in store.registry().collect()}
    return found.get(table.name)


def test_batches_and_mark_are_published_together(spark, store):
    store.seed(ACCOUNT, target(spark, ACCOUNT, [(1, "a", 0, False)]), DAY)
    assert mark(store, ACCOUNT) == DAY
    batch = frame(spark, ACCOUNT, [change(1, 4, 1, "b"), change(2, 2, 2, "c"), change(3, 1, 9)])
    assert store.apply(ACCOUNT, batch) == 3
    assert rows_of(store.read(ACCOUNT)) == [(1, "b", 0, False), (2, "c", 0, False)]
    assert mark(store, ACCOUNT) == DAY + timedelta(seconds=3)


def test_empty_batch(spark, store):
    store.seed(ACCOUNT, target(spark, ACCOUNT, [(1, "a", 0, False)]), DAY)
    before = store.state(ACCOUNT)
    assert store.apply(ACCOUNT, frame(spark, ACCOUNT, [])) == 0
    assert store.state(ACCOUNT) == before


def test_a_batch_that_died_before_its_commit_leaves_no_trace(spark, store):
    store.seed(PLACE, target(spark, PLACE, [(1, "a", 0, False, True)]))
    lost = frame(spark, PLACE, [change(1, 2, 1, "lost", 5), change(2, 2, 2, "lost", 5)])
    write_stage(lost, store._batch_path(PLACE, 1), PLACE)
    assert rows_of(store.read(PLACE)) == [(1, "a", 0, False, True)]
    store.apply(PLACE, frame(spark, PLACE, [change(1, 2, 1, "b", 1)]))
    assert rows_of(store.read(PLACE)) == [(1, "a", 0, False, False), (1, "b", 1, False, True)]


def test_a_batch_delivered_twice_counts_once(spark, store):
    batch = frame(spark, PLACE, [change(1, 2, 1, "a", 1)])
    assert store.apply(PLACE, batch, source="s", source_batch=0) == 1
    assert store.apply(PLACE, batch, source="s", source_batch=0) == 0
    assert store.read(PLACE).count() == 1
    assert store.apply(PLACE, batch) == 1  # in between, without a source
    assert store.apply(PLACE, batch, source="s", source_batch=0) == 0
    assert store.apply(PLACE, batch, source="other", source_batch=0) == 1
    assert store.read(PLACE).count() == 3


@pytest.mark.parametrize("table", [ACCOUNT, PLACE], ids=lambda t: t.name)
def test_compaction_changes_no_row(spark, tmp_path, table):
    batches = [
        [change(1, 2, 1, "a", 1), change(2, 1, 1, day=0), change(3, 2, 2, "b", 2)],
        [change(4, 4, 1, "c", 0), change(5, 1, 3, day=1)],
        [change(6, 2, 3, "d", 1), change(7, 1, 2, day=2)],
    ]
    results = []
    for n, every in enumerate((1, 2, 200)):
        store = TargetStore(spark, f"{tmp_path}/{n}", compact_batches=every)
        for batch in batches:
            store.apply(table, frame(spark, table, batch))
        results.append((rows_of(store.read(table)), store.state(table).snapshot_id))
    assert results[0][0] == results[1][0] == results[2][0]
    assert [snapshot for _, snapshot in results] == [3, 2, None]


def test_compaction_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.targets.BROADCAST_BYTES", 1)
    store = TargetStore(spark, str(tmp_path), compact_share=10.0)
    for n in range(1, 4):
        store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(n, 2, n, "x")]))
    state = store.state(ACCOUNT)
    assert state.snapshot_id == 1 and list(state.open_batches) == [2, 3]


def test_a_commit_that_broke_off_is_not_read(spark, store, tmp_path):
    store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(1, 2, 1, "x")]))
    commits = tmp_path / "commits" / ACCOUNT.name
    (commits / ".000000000002.json-draft").write_text('{"commit_id": 2, "batch_')
    assert store.state(ACCOUNT).batch_id == 1
    assert rows_of(store.read(ACCOUNT)) == [(1, "x", 0, False)]
    store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(2, 2, 2, "y")]))
    assert store.read(ACCOUNT).count() == 2


def test_a_few_commits_are_kept(spark, store, tmp_path):
    for n in range(1, KEPT_COMMITS + 3):
        store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(n, 2, n, "x")]))
    state = store.state(ACCOUNT)
    assert (state.commit_id, state.batch_id) == (KEPT_COMMITS + 2, KEPT_COMMITS + 2)
    assert len(list((tmp_path / "commits" / ACCOUNT.name).glob("*.json"))) == KEPT_COMMITS
    assert mark(store, ACCOUNT) == DAY + timedelta(seconds=KEPT_COMMITS + 2)
    assert store.read(ACCOUNT).count() == KEPT_COMMITS + 2


def test_of_two_writers_from_one_state_the_second_stops(spark, store):
    store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(1, 2, 1, "a")]))
    state = store.state(ACCOUNT)
    first, second = (frame(spark, ACCOUNT, [change(2, 2, n, "b")]) for n in (2, 3))
    store.apply(ACCOUNT, first, state=state)
    with pytest.raises(CommitConflict, match="commit 2 exists"):
        store.apply(ACCOUNT, second, state=state)
    assert rows_of(store.read(ACCOUNT)) == [(1, "a", 0, False), (2, "b", 0, False)]
    with pytest.raises(CommitConflict):
        store.compact(ACCOUNT, state)
    assert store.apply(ACCOUNT, second) == 1
    assert store.read(ACCOUNT).count() == 3


def test_a_cycle_stops_if_another_writer_was_faster(spark, store):
    def log(mark):
        store.apply(PLACE, frame(spark, PLACE, [change(5, 2, 9, "other")]))
        return frame(spark, PLACE, [change(1, 2, 1, "own")])

    with pytest.raises(CommitConflict):
        run_cycle(store, {"p": log}, {"p": PLACE}, default=EARLY)
    assert [r[1] for r in rows_of(store.read(PLACE))] == ["other"]


KEYS = 400


def wide_history(table, batches):
    """Batches after a first one of all keys: few keys each, some of them new or deleted."""
    rows = [[change(1, 2, key, "first", 0) for key in range(KEYS)]]
    for n in range(2, batches + 2):
        keys = [n, n + 50, KEYS + n]
        rows.append([change(n, 1 if k == n + 50 else 4, k, f"in {n}", n) for k in keys])
    return rows


@pytest.mark.parametrize("table", [ACCOUNT, PLACE], ids=lambda t: t.name)
def test_compaction_rewrites_touched_buckets_only(spark, tmp_path, table):
    plain = TargetStore(spark, f"{tmp_path}/plain")
    store = TargetStore(spark, f"{tmp_path}/buckets", bucket_bytes=2_000)
    first, *batches = [frame(spark, table, rows) for rows in wide_history(table, 4)]
    for target_store in (plain, store):
        target_store.apply(table, first)
    before = store.compact(table)
    assert len(before.levels) >= 32 and set(before.levels) == {1}
    for batch in batches[:2]:
        plain.apply(table, batch)
        store.apply(table, batch)
    after = store.compact(table)
    changed = [a != b for a, b in zip(after.folders, before.folders, strict=True)]
    assert 0 < sum(changed) <= 6
    assert after.snapshot_id == 3 and not after.batches.keys() - {"3"}
    written = spark.read.parquet(f"{store.root}/snapshots/{table.name}/batch_id=3/*").count()
    assert written < store.read(table).count() / 3
    for batch in batches[2:]:
        plain.apply(table, batch)
        store.apply(table, batch)
    assert rows_of(store.read(table)) == rows_of(plain.read(table))


@pytest.mark.parametrize("table", [ACCOUNT, PLACE], ids=lambda t: t.name)
def test_buckets_with_few_changes_wait(spark, tmp_path, table):
    plain = TargetStore(spark, f"{tmp_path}/plain")
    store = TargetStore(spark, f"{tmp_path}/buckets", bucket_bytes=2_000)
    first, *batches = [frame(spark, table, rows) for rows in wide_history(table, 3)]
    # all rows of one batch are of one key, whose bucket is due
    batches.append(frame(spark, table, [change(9 + n, 4, 77, f"much {n}", n) for n in range(60)]))
    for target_store in (plain, store):
        target_store.apply(table, first)
    store.compact(table)
    for batch in batches:
        plain.apply(table, batch)
        store.apply(table, batch)
    after = store.compact(table, share=0.5)
    assert len(set(after.levels)) == 2 and after.snapshot_id == 1
    assert list(after.open_batches) == [2, 3, 4, 5] and after.batches_bytes > 0
    assert rows_of(store.read(table)) == rows_of(plain.read(table))
    more = frame(spark, table, [change(99, 4, 77, "last", 99), change(100, 1, 3, day=99)])
    for target_store in (plain, store):
        target_store.apply(table, more)
    assert rows_of(store.read(table)) == rows_of(plain.read(table))
    assert store.compact(table).batches_bytes == 0
    assert rows_of(store.read(table)) == rows_of(plain.read(table))


@pytest.mark.parametrize("bucket_bytes", [2_000, 14_000], ids=["split", "kept"])
def test_compaction_gathers_only_rows_that_may_have_changed(spark, tmp_path, monkeypatch, bucket_bytes):
    """Nothing is broadcast: the others are written from where they are read,
    in buckets that are split and in buckets that are kept."""
    monkeypatch.setattr("tidemark.operators.joins.BROADCAST_BYTES", -1)
    gathered = []
    write = TargetStore._write_buckets

    def spy(self, rows, table, batch_id, buckets, placed=None):
        gathered.append((rows.count(), placed.count() if placed is not None else None))
        return write(self, rows, table, batch_id, buckets, placed)

    monkeypatch.setattr(TargetStore, "_write_buckets", spy)
    store = TargetStore(spark, f"{tmp_path}/buckets", bucket_bytes=bucket_bytes)
    plain = TargetStore(spark, f"{tmp_path}/plain")
    first, *batches = wide_history(ACCOUNT, 2)
    first += [change(1, 1, key) for key in range(300, 310)]
    more = [change(50 + k, 2, 1_000 + k, "more", 9) for k in range(KEYS if bucket_bytes == 2_000 else 3)]
    for rows in (first, batches[0] + more, batches[1]):
        for target_store in (plain, store):
            target_store.apply(ACCOUNT, frame(spark, ACCOUNT, rows))
        store.compact(ACCOUNT)
        assert rows_of(store.read(ACCOUNT)) == rows_of(plain.read(ACCOUNT))
        state = store.state(ACCOUNT)
        kept = spark.read.parquet(*[f"{store.root}/{folder}" for folder in state.folders if folder])
        lies = F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1).cast("int")
        assert not kept.filter(store._bucket(ACCOUNT, len(state.folders)) != lies).count()
    moved, stayed = zip(*gathered, strict=True)
    assert stayed[0] is None and moved[0] == KEYS
    assert stayed[1] > 100 and moved[1] < len(more) + 60
    assert stayed[2] > 0 and moved[2] < 60


def test_a_growing_table_gets_more_buckets(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path), bucket_bytes=2_000)
    counts = []
    for n in range(3):
        rows = [change(n + 1, 2, key, "x") for key in range(30 * 4**n)]
        store.apply(ACCOUNT, frame(spark, ACCOUNT, rows))
        counts.append(len(store.compact(ACCOUNT).levels))
    assert counts == sorted(set(counts)) and counts[-1] >= 16
    assert store.read(ACCOUNT).count() == 480


def test_many_small_batches_are_merged_between_polls(spark, store, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.targets.MERGE_BATCHES", 3)
    for n in range(1, 12):
        store.apply(PLACE, frame(spark, PLACE, [change(n, 2 if n % 3 else 1, n % 4, "x", n)]))
        before = rows_of(store.read(PLACE))
        store.maintain(PLACE)
        assert rows_of(store.read(PLACE)) == before
        assert len(store.state(PLACE).batches) <= 5
    assert store.state(PLACE).snapshot_id is None
    store.compact(PLACE)
    assert rows_of(store.read(PLACE)) == before
    assert store.state(PLACE).snapshot_id == 11


def test_vacuum_removes_what_no_commit_names(spark, store, tmp_path):
    for n in range(1, 4):
        store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(n, 2, n, "x")]))
        store.compact(ACCOUNT)
    write_stage(
        frame(spark, ACCOUNT, [change(9, 2, 9)]),
        f"{store._batch_path(ACCOUNT, 4)}/attempt=alost",
        ACCOUNT,
    )
    assert store.vacuum(ACCOUNT) == 0  # all of it is young
    assert store.vacuum(ACCOUNT, older_than_hours=0) == 1  # kept commits name the others
    for old in store._commits(ACCOUNT.name)[:-1]:
        store.files.delete(old)
    assert store.vacuum(ACCOUNT, older_than_hours=0) == 4  # two snapshots, two batches
    assert store.read(ACCOUNT).count() == 3
    assert store.vacuum(ACCOUNT, older_than_hours=0) == 0


def test_an_image_without_key_stops_the_batch(spark, store):
    with pytest.raises(Exception, match="image without account_id"):
        store.apply(ACCOUNT, frame(spark, ACCOUNT, [change(1, 2, None, "x")]))
    assert store.state(ACCOUNT).commit_id == 0


def test_seeding_twice_is_refused(spark, store):
    store.seed(ACCOUNT, target(spark, ACCOUNT))
    with pytest.raises(ValueError, match="already has content"):
        store.seed(ACCOUNT, target(spark, ACCOUNT))


def cycle(spark, store, account_rows, place_rows, **options):
    logs = {"a": frame(spark, ACCOUNT, account_rows), "p": frame(spark, PLACE, place_rows)}
    return run_cycle(store, logs, {"a": ACCOUNT, "p": PLACE}, default=EARLY, **options)


def test_cycles_read_on_from_the_mark(spark, store):
    accounts = [change(1, 2, 1, "a"), change(2, 3, 1, "x")]
    assert cycle(spark, store, accounts, []) == {"a": 1, "p": 0}
    assert mark(store, ACCOUNT) == DAY + timedelta(seconds=1)
    accounts += [change(3, 4, 1, "b"), change(4, 1, 1)]
    assert cycle(spark, store, accounts, [change(1, 2, 5, "p", 1)]) == {"a": 2, "p": 1}
    assert cycle(spark, store, accounts, [change(1, 2, 5, "p", 1)]) == {"a": 0, "p": 0}
    assert rows_of(store.read(ACCOUNT)) == [(1, "b", 0, True)]
    assert rows_of(store.read(PLACE)) == [(5, "p", 1, False, True)]


@pytest.mark.parametrize(("exact", "versions"), [(False, 2), (True, 1)])
def test_rows_of_a_partial_ms_are_read_again_unless_exact(spark, store, exact, versions):
    log = [change(1, 2, 5, "p", 1, at=DAY + timedelta(microseconds=1500))]
    for _ in range(2):
        cycle(spark, store, [], log, exact=exact)
    assert store.read(PLACE).count() == versions


def test_a_change_with_the_time_of_the_mark_is_never_read(spark, store):
    log = [change(1, 2, 1, "a", at=DAY)]
    cycle(spark, store, log, [])
    cycle(spark, store, [*log, change(2, 2, 2, "late", at=DAY)], [])
    assert rows_of(store.read(ACCOUNT)) == [(1, "a", 0, False)]


def test_no_change_is_applied_twice_and_none_is_lost(spark, store):
    """Times at and in the mark's millisecond, one late, one with the time of the mark."""
    at = [DAY + timedelta(microseconds=us) for us in (1000, 1500, 1500, 1200, 3000)]
    rows = [change(n, 2, 5, f"v{n}", n, at=t) for n, t in enumerate(at)]
    for visible in (2, 2, 3, 4, 4, 5, 5):
        cycle(spark, store, [], rows[:visible], no_reread=True)
    assert [r[1] for r in rows_of(store.read(PLACE))] == ["v0", "v1", "v2", "v3", "v4"]


def test_no_reread_over_batches_of_one_millisecond(spark, store):
    """What was seen lies in several batches, and in compacted and merged ones."""
    rows = [change(n, 2, n, "v", n, at=DAY + timedelta(microseconds=n)) for n in range(6)]
    for visible in range(1, 7):
        cycle(spark, store, [], rows[:visible], no_reread=True)
        if visible == 3:
            store.compact(PLACE)
        store.vacuum(PLACE, older_than_hours=0)
    assert store.read(PLACE).count() == 6
    assert store.seen_at_mark(PLACE).count() == 6


def test_no_reread_after_a_first_content(spark, store):
    mark = DAY + timedelta(microseconds=1500)
    store.seed(PLACE, target(spark, PLACE, [(1, "seed", 0, False, True)]), mark)
    rows = [change(1, 2, 1, "in it", at=mark), change(2, 2, 1, "new", at=mark + timedelta(microseconds=9))]
    for _ in range(2):
        cycle(spark, store, [], rows, no_reread=True)
    assert sorted(r[1] for r in rows_of(store.read(PLACE))) == ["new", "seed"]
    with pytest.raises(ValueError, match="no_reread"):
        cycle(spark, store, [], [], no_reread=True, exact=True)


def test_a_lost_delete_read_again_counts(spark, store):
    """Its key was unknown the first time; the re-read meets the insert."""
    log = [change(1, 1, 1, at=DAY + timedelta(microseconds=1500))]
    cycle(spark, store, log, [])
    cycle(spark, store, [*log, change(2, 2, 1, "in")], [])
    assert rows_of(store.read(ACCOUNT)) == [(1, "in", 0, True)]


def test_a_log_of_the_wrong_shape_stops_the_cycle_before_any_write(spark, store):
    log = frame(spark, ACCOUNT, [change(1, 2, 1, "a")])
    with pytest.raises(ValueError, match="note string"):
        run_cycle(store, {"a": log.drop("note")}, {"a": ACCOUNT}, default=EARLY)
    with pytest.raises(KeyError, match="unknown table"):
        run_cycle(store, {"dim_unknown": log}, default=EARLY)
    assert store.state(ACCOUNT).commit_id == 0


def test_a_log_may_be_a_function_of_the_mark(spark, store):
    marks = []

    def log(mark):
        marks.append(mark)
        return frame(spark, ACCOUNT, [change(len(marks), 2, len(marks), "x")])

    for _ in range(2):
        run_cycle(store, {"a": log}, {"a": ACCOUNT}, default=EARLY)
    assert marks == [EARLY, DAY + timedelta(seconds=1)]
    assert store.read(ACCOUNT).count() == 2


def test_a_failing_table_does_not_hold_up_the_others(spark, store):
    logs = {
        "a": frame(spark, ACCOUNT, [change(1, 2, None)]),
        "p": frame(spark, PLACE, [change(1, 2, 1)]),
    }
    with pytest.raises(Exception, match="image without account_id"):
        run_cycle(store, logs, {"a": ACCOUNT, "p": PLACE}, default=EARLY)
    assert store.state(ACCOUNT).commit_id == 0
    assert store.read(PLACE).count() == 1


def test_a_failed_replace_keeps_the_rows_before(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert read_stage(spark, path, ACCOUNT).count() == 0
    for n in (1, 2, 3):
        replace_stage(frame(spark, ACCOUNT, [change(1, 2, n, "a")]), path, ACCOUNT)
        assert [r["account_id"] for r in read_stage(spark, path, ACCOUNT).collect()] == [n]
    with pytest.raises(Exception, match="image without"):
        replace_stage(frame(spark, ACCOUNT, [change(1, 2, None, "a")]), path, ACCOUNT)
    assert [r["account_id"] for r in read_stage(spark, path, ACCOUNT).collect()] == [3]


def test_polls_are_merged_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.stage.MERGE_FOLDERS", 3)
    monkeypatch.setattr("tidemark.sinks.stage.TIER_BYTES", 400)
    path, rows, counts = str(tmp_path / "log"), [], []
    assert read_polls(spark, path, ACCOUNT).count() == merge_polls(spark, path, ACCOUNT) == 0
    for poll in range(1, 15):
        rows.append(change(poll, 3 if poll % 2 else 4, poll, "x"))
        append_poll(spark, path, frame(spark, ACCOUNT, rows), ACCOUNT, poll, EARLY)
        merge_polls(spark, path, ACCOUNT)
        counts.append(len(_Switch(spark, path).last()[1]))
        found = read_polls(spark, path, ACCOUNT).orderBy("poll").collect()
        assert [(r.account_id, r.poll) for r in found] == [(n, n) for n in range(1, poll + 1)]
    assert max(counts) <= 6
    with pytest.raises(ValueError, match="merged with others"):
        append_poll(spark, path, frame(spark, ACCOUNT, rows), ACCOUNT, 2, EARLY)
    named = len(_Switch(spark, path).last()[1])
    for name in _Switch(spark, path)._names()[:-1]:
        _Switch(spark, path).folder.delete(f"switch/{name}")
    assert remove_unnamed(spark, path) == 0 and remove_unnamed(spark, path, 0) > 10
    assert read_polls(spark, path, ACCOUNT).count() == 14
    assert len(list((tmp_path / "log").glob("*-*"))) == named


def test_two_polls_from_one_state(spark, tmp_path):
    path = str(tmp_path / "log")
    append_poll(spark, path, frame(spark, ACCOUNT, [change(1, 2, 1)]), ACCOUNT, 1, EARLY)
    late = _Switch(spark, path)
    number, folders = late.last()
    append_poll(spark, path, frame(spark, ACCOUNT, [change(2, 2, 2)]), ACCOUNT, 2, EARLY)
    with pytest.raises(SwitchConflict):
        late.turn(number, folders)
    assert read_polls(spark, path, ACCOUNT).count() == 2


def test_replaced_loads_are_removed(spark, tmp_path):
    path = str(tmp_path / "stage")
    for n in range(5):
        replace_stage(frame(spark, ACCOUNT, [change(1, 2, n, "a")]), path, ACCOUNT)
    assert len(list((tmp_path / "stage").glob("load-*"))) == 2
