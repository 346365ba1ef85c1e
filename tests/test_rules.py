"""One small feed per rule of the apply procedure, with the rows it must give."""

from datetime import datetime, timedelta

import pytest
from model import ACCOUNT, DAY, PLACE, change, frame, rows_of, target

from tidemark.config import DEFAULT_WATERMARK
from tidemark.operators import changes, replay, type1, versioned, watermark
from tidemark.sinks.stage import append_poll, read_polls
from tidemark.sources.change_log import changes_after


def accounts(spark, seed, *batches):
    frames = [frame(spark, ACCOUNT, b) for b in batches]
    return rows_of(replay.apply_batches(target(spark, ACCOUNT, seed), frames, ACCOUNT))


def places(spark, seed, *batches):
    frames = [frame(spark, PLACE, b) for b in batches]
    return rows_of(replay.apply_batches(target(spark, PLACE, seed), frames, PLACE))


def test_delete_wins_inside_a_batch_in_either_order(spark):
    batch = [change(1, 1, 7), change(2, 2, 7, "back"), change(3, 2, 8, "in"), change(4, 1, 8)]
    seed = [(7, "old", 0, False)]
    assert accounts(spark, seed, batch) == [(7, "back", 0, True), (8, "in", 0, True)]


def test_deleted_flag_is_sticky(spark):
    first, second = [change(1, 1, 7)], [change(2, 2, 7, "new", 1)]
    assert accounts(spark, [(7, "old", 0, False)], first, second) == [(7, "new", 1, True)]


def test_versioned_insert_after_delete_starts_undeleted(spark):
    first, second = [change(1, 1, 7, day=0)], [change(2, 2, 7, "new", 1)]
    got = places(spark, [(7, "old", 0, False, True)], first, second)
    assert got == [(7, "new", 1, False, True), (7, "old", 0, True, False)]


def test_delete_of_an_unknown_key_is_lost(spark):
    assert accounts(spark, [], [change(1, 1, 7)], [change(2, 2, 7, "in")]) == [
        (7, "in", 0, False)
    ]


def test_latest_is_by_sequence_not_by_time_or_date(spark):
    batch = [
        change(9, 4, 7, "last", day=0, at=DAY),
        change(8, 4, 7, "earlier", day=5, at=DAY + timedelta(days=1)),
    ]
    assert accounts(spark, [], batch) == [(7, "last", 0, False)]
    assert changes.latest_images(frame(spark, ACCOUNT, batch), ACCOUNT).first()["note"] == "last"


def test_whole_row_is_overwritten_nulls_included(spark):
    batch = [change(1, 4, 7, None, None)]
    assert accounts(spark, [(7, "old", 0, False)], batch) == [(7, None, None, False)]


def test_current_follows_the_batch_even_if_it_is_older(spark):
    seed = [(7, "new", 9, False, True)]
    assert places(spark, seed, [change(1, 4, 7, "old", 3)]) == [
        (7, "new", 9, False, False),
        (7, "old", 3, False, True),
    ]


def test_ties_give_several_current_versions_and_no_match_gives_none(spark):
    batch = [change(1, 4, 7, "a", 3), change(2, 4, 7, "b", 3), change(3, 4, 8, "c", None)]
    seed = [(8, "old", 1, False, True)]
    assert places(spark, seed, batch) == [
        (7, "a", 3, False, True),
        (7, "b", 3, False, True),
        (8, "c", None, False, False),
        (8, "old", 1, False, False),
    ]


def test_delete_only_batch_moves_the_current_flag(spark):
    seed = [(7, "a", 1, False, True), (7, "b", 2, False, False), (9, "z", 1, False, True)]
    assert places(spark, seed, [change(1, 1, 7, day=2)]) == [
        (7, "a", 1, True, False),
        (7, "b", 2, True, True),
        (9, "z", 1, False, True),
    ]


def test_empty_batch_changes_nothing(spark):
    seed = [(7, "old", 0, True)]
    assert accounts(spark, seed, []) == seed
    registry = spark.createDataFrame([("dim_account", DAY)], watermark.REGISTRY_SCHEMA)
    after = watermark.advance_watermark(registry, frame(spark, ACCOUNT, []), "dim_account")
    assert [tuple(r) for r in after.collect()] == [("dim_account", DAY)]


def test_mark_covers_all_operations_and_may_go_back(spark):
    registry = spark.createDataFrame(
        [("dim_account", DAY + timedelta(days=9)), ("other", None)], watermark.REGISTRY_SCHEMA
    )
    batch = frame(spark, ACCOUNT, [change(1, 2, 7), change(5, 1, 99)])
    after = watermark.advance_watermark(registry, batch, "dim_account").collect()
    assert {tuple(r) for r in after} == {
        ("dim_account", DAY + timedelta(seconds=5)),
        ("other", None),
    }


def test_lookup_cuts_to_ms_and_fills_in_the_default(spark):
    mark = datetime(2024, 3, 1, 1, 2, 3, 999999)
    registry = spark.createDataFrame([("a", mark), ("b", None)], watermark.REGISTRY_SCHEMA)

    def look(**options):
        found = watermark.lookup_watermarks(registry, ["a", "b", "c"], **options).collect()
        return {r["table_name"]: r["last_update"] for r in found}

    assert look() == {
        "a": datetime(2024, 3, 1, 1, 2, 3, 999000),
        "b": DEFAULT_WATERMARK,
        "c": DEFAULT_WATERMARK,
    }
    assert look(exact=True)["a"] == mark


@pytest.mark.parametrize(("exact", "expected"), [(False, [1, 1, 2]), (True, [1, 2])])
def test_polls_read_the_last_partial_ms_again(spark, tmp_path, exact, expected):
    first = [change(1, 2, 1, at=DAY + timedelta(microseconds=1500))]
    second = [*first, change(2, 2, 2, at=DAY + timedelta(seconds=1))]
    for poll, rows in enumerate([first, second], start=1):
        log = frame(spark, ACCOUNT, rows)
        append_poll(
            spark, str(tmp_path), log, ACCOUNT, poll, datetime(2000, 1, 1), exact=exact
        )
    keys = [r["account_id"] for r in read_polls(spark, str(tmp_path), ACCOUNT).collect()]
    assert sorted(keys) == expected


def test_a_poll_run_again_replaces_its_rows(spark, tmp_path):
    log = frame(spark, ACCOUNT, [change(1, 2, 1), change(2, 3, 1), change(3, 4, 1)])
    for poll in (1, 1):
        append_poll(spark, str(tmp_path), log, ACCOUNT, poll, datetime(2000, 1, 1))
    assert read_polls(spark, str(tmp_path), ACCOUNT).count() == 3


def test_scan_is_strict_and_drops_before_images_and_nulls(spark):
    rows = [
        change(1, 2, 1, at=DAY),
        change(2, 2, 2, at=DAY + timedelta(microseconds=1)),
        change(3, 3, 3),
        (None, None, "0x1", 2, 1, 4, None, None),
        (DAY + timedelta(days=1), None, "0x1", None, 1, 5, None, None),
    ]
    log = frame(spark, ACCOUNT, rows)
    assert [r["account_id"] for r in changes_after(log, DAY).collect()] == [2]
    assert [
        r["account_id"] for r in changes_after(log, DAY, before_images=True).collect()
    ] == [2, 3, 5]


def test_versions_are_not_deduplicated(spark):
    batch = [change(1, 2, 7, "a", 1), change(2, 4, 7, "b", 2)]
    assert len(places(spark, [], batch, batch)) == 4
    assert accounts(spark, [], batch, batch) == [(7, "b", 2, False)]


def test_ties_on_the_sequence_are_decided_by_the_row(spark):
    batch = [change(1, 2, 7, n, at=DAY) for n in ("b", "c", "a")]
    for order in (batch, batch[::-1]):
        assert accounts(spark, [], order) == [(7, "c", 0, False)]


def test_a_delete_without_key_matches_nothing(spark):
    seed = [(7, "old", 0, False)]
    assert accounts(spark, seed, [change(1, 1, None)]) == seed
    assert changes.deleted_keys(frame(spark, ACCOUNT, [change(1, 1, None)]), ACCOUNT).count() == 0


def test_single_steps_add_up_to_the_batch(spark):
    batch = frame(spark, ACCOUNT, [change(1, 2, 7, "a"), change(2, 1, 7), change(3, 1, 8)])
    seed = target(spark, ACCOUNT, [(8, "x", 0, False), (9, "y", 0, True)])
    steps = type1.soft_delete(
        type1.upsert(seed, batch, ACCOUNT), changes.deleted_keys(batch, ACCOUNT), ACCOUNT
    )
    assert rows_of(steps) == rows_of(type1.apply_batch(seed, batch, ACCOUNT))

    batch = frame(spark, PLACE, [change(1, 2, 7, "a", 1), change(2, 1, 8, day=0)])
    seed = target(spark, PLACE, [(8, "x", 0, False, False), (9, "y", 0, True, True)])
    steps = versioned.append_versions(seed, batch, PLACE)
    steps = versioned.soft_delete(steps, changes.deleted_keys(batch, PLACE), PLACE)
    steps = versioned.reset_current(steps, batch, PLACE)
    steps = versioned.set_current(steps, batch, PLACE)
    assert rows_of(steps) == rows_of(versioned.apply_batch(seed, batch, PLACE))


def test_full_ties_do_not_depend_on_order(spark):
    rows = [change(1, 2, 1, note) for note in ("b", None, "a")]
    for given in (rows, rows[::-1]):
        log = frame(spark, ACCOUNT, given).coalesce(1)
        assert [r["note"] for r in changes.latest_images(log, ACCOUNT).collect()] == ["b"]


def test_a_poll_reads_only_what_its_marks_leave_open(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [change(n, 2, n, at=DAY + timedelta(seconds=n)) for n in range(1, 5)]
    for poll, n in ((1, 1), (5, 2), (21, 3), (21, 4)):  # poll 21 replaces the mark of poll 5
        log = frame(spark, ACCOUNT, rows[:n])
        append_poll(spark, path, log, ACCOUNT, poll, datetime(2000, 1, 1), exact=True)
    found = [(r["account_id"], r["poll"]) for r in read_polls(spark, path, ACCOUNT).collect()]
    assert sorted(found) == [(1, 1), (2, 5), (3, 21), (4, 21)]
