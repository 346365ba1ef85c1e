"""Physical plans: what is pushed down, reduced before a shuffle, or not shuffled."""

from datetime import timedelta

import re

import pytest
from model import ACCOUNT, DAY, PLACE, change, frame, target

from tidemark.operators import changes, type1, versioned
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.sources.change_log import changes_after


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Change log and targets as files, as a job would find them."""
    root = str(tmp_path_factory.mktemp("plans"))
    frame(spark, ACCOUNT, [change(1, 2, 1, "a")]).write.parquet(f"{root}/log")
    target(spark, ACCOUNT, [(1, "a", 0, False)]).write.parquet(f"{root}/account")
    target(spark, PLACE, [(1, "a", 0, False, True)]).write.parquet(f"{root}/place")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("log", "account", "place")}


@pytest.fixture
def no_auto_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_scan_pushes_filters_and_prunes_columns(stored):
    text = plan(changes_after(stored["log"], DAY).select("account_id"))
    assert "GreaterThan(start_lsn" in text and "Not(EqualTo" in text
    read = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "note" not in read and "seqval" not in read


def test_scan_of_a_dated_log_skips_older_dates(spark, tmp_path):
    log = frame(
        spark, ACCOUNT, [change(n, 2, n, at=DAY + timedelta(days=n)) for n in range(6)]
    )
    dated = log.withColumn("commit_date", log["start_lsn"].cast("date"))
    dated.write.partitionBy("commit_date").parquet(f"{tmp_path}/log")
    log, mark = spark.read.parquet(f"{tmp_path}/log"), DAY + timedelta(days=3)
    found = changes_after(log, mark, date_partition="commit_date")
    assert sorted(r["account_id"] for r in found.collect()) == [4, 5]
    assert "PartitionFilters: [isnotnull(commit_date" in plan(found)


def test_latest_image_is_limited_before_the_shuffle(stored):
    text = plan(changes.latest_images(stored["log"], ACCOUNT))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_net_changes_are_reduced_before_one_shuffle(stored):
    history = stored["log"].selectExpr("*", "1 AS batch_no")
    text = plan(type1.net_changes(history, ACCOUNT))
    assert "partial_max" in text and text.count("Exchange hashpartitioning") == 1


def test_small_batch_does_not_shuffle_the_target(stored, no_auto_broadcast):
    account = plan(
        type1.apply_batch(stored["account"], stored["log"], ACCOUNT, BROADCAST_BYTES)
    )
    place = plan(versioned.apply_batch(stored["place"], stored["log"].withColumnRenamed(
        "account_id", "place_id"), PLACE, BROADCAST_BYTES))
    for text in (account, place):
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def broadcast_keys(text):
    """Keys of the broadcast joins of a plan, without their numbers."""
    return {re.sub(r"#\d+L?", "", k) for k in re.findall(r"BroadcastHashJoin \[(\S+?)\]", text)}


def test_batch_of_unknown_size_is_not_broadcast(stored, no_auto_broadcast):
    """Only the bitmap of its keys is, which has a bound."""
    for size in (None, BROADCAST_BYTES + 1):
        text = plan(type1.apply_batch(stored["account"], stored["log"], ACCOUNT, size))
        assert "SortMergeJoin" in text and broadcast_keys(text) == {"__page"}
        place_log = stored["log"].withColumnRenamed("account_id", "place_id")
        text = plan(versioned.apply_batch(stored["place"], place_log, PLACE, size))
        assert "SortMergeJoin" in text and broadcast_keys(text) == {"__page"}


def test_no_python_in_any_plan(stored):
    for df in (
        type1.apply_batch(stored["account"], stored["log"], ACCOUNT),
        changes.latest_images(stored["log"], ACCOUNT),
    ):
        assert "Python" not in plan(df)
