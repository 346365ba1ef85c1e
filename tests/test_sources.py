"""Names, schemas, raw change tables, ad-hoc queries and connection options."""

from datetime import timedelta
from pathlib import Path

import pytest
from model import ACCOUNT, DAY, change, frame
from pyspark.sql import functions as F

from tidemark.config import SALES_TABLES, define_table, source_column, table_config
from tidemark.plans.cycle import run_cycle
from tidemark.sinks.targets import TargetStore
from tidemark.sources import jdbc
from tidemark.sources.change_log import (
    changes_after,
    check_schema,
    commit_times,
    raw_changes_after,
    read_raw_changes,
    transaction_times,
)
from tidemark.sources.file_index import FileIndex
from tidemark.sources.query import query_frame


def test_names_at_the_source():
    detail = table_config("fact_sales_order_detail")
    assert detail.source_table == "salesorderdetail"
    assert detail.change_table == "cdc.SalesLT_salesorderdetail_CT"
    assert source_column("address_line1") == "addressline1"
    with pytest.raises(KeyError, match="dim_nothing"):
        table_config("dim_nothing")


def test_configured_tables():
    shapes = {t.name: (t.key, len(t.columns), t.versioned) for t in SALES_TABLES.values()}
    assert shapes == {
        "dim_address": ("address_id", 9, False),
        "dim_customer": ("customer_id", 14, False),
        "dim_customer_address": ("customer_address_id", 6, False),
        "dim_region": ("region_id", 3, True),
        "fact_sales_order_detail": ("sales_order_detail_id", 9, False),
        "fact_sales_order_header": ("sales_order_id", 22, False),
    }


def test_schema_check(spark):
    good = frame(spark, ACCOUNT, [change(1, 2, 1)])
    assert check_schema(good, ACCOUNT) is good
    with pytest.raises(ValueError, match="seqval string"):
        check_schema(good.withColumn("seqval", F.lit(1)), ACCOUNT)


def raw_side(spark):
    """Positions 1 to 4; position 3 is not in the time table."""
    rows = [
        (bytes([n]), None, bytes([0, n]), op, 1, n, f"n{n}", DAY, "x")
        for n, op in [(1, 2), (2, 2), (3, 2), (4, 3), (5, 4)]
    ]
    raw = spark.createDataFrame(
        rows,
        "`__$start_lsn` binary, `__$end_lsn` binary, `__$seqval` binary, `__$operation` int, "
        "`__$command_id` int, AccountID long, Note string, ModifiedDate timestamp_ntz, "
        "Other string",
    )
    times = spark.createDataFrame(
        [(bytes([n]), DAY + timedelta(seconds=n)) for n in (1, 2, 4, 5)],
        "lsn binary, commit_time timestamp_ntz",
    )
    return raw, times


@pytest.mark.parametrize(
    ("seconds", "images", "expected"),
    [(0, False, [1, 2, 5]), (1, False, [2, 5]), (1, True, [2, 4, 5]), (9, False, [])],
)
def test_raw_scan(spark, seconds, images, expected):
    raw, times = raw_side(spark)
    got = raw_changes_after(raw, times, ACCOUNT, DAY + timedelta(seconds=seconds), images)
    assert got.schema.names == ACCOUNT.stage_schema.names
    rows = got.orderBy("account_id").collect()
    assert [r["account_id"] for r in rows] == expected
    assert [r["seqval"] for r in rows] == [f"0x00{n:02X}" for n in expected]


def test_end_positions_are_looked_up_if_there_are_any(spark):
    raw, times = raw_side(spark)
    assert read_raw_changes(raw, times, ACCOUNT).filter("end_lsn is not null").isEmpty()
    ended = raw.withColumn("__$end_lsn", F.when(F.col("AccountID") < 4, F.col("__$start_lsn")))
    got = read_raw_changes(ended, times, ACCOUNT).orderBy("account_id").collect()
    want = [DAY + timedelta(seconds=n) if n in (1, 2) else None for n in range(1, 6)]
    assert [r["end_lsn"] for r in got] == want
    assert [r["start_lsn"] for r in got][2:4] == [None, DAY + timedelta(seconds=4)]


@pytest.mark.parametrize("rows_per_task", [1, 3, 1000])
def test_transactions_are_looked_up_once(spark, rows_per_task):
    """Hot, unknown and missing positions, alone or in pairs."""
    raw, times = raw_side(spark)
    pairs = [(1, 1), (1, 2), (1, None), (3, 4), (3, 3), (None, 5), (None, None), (4, 9)]
    rows = [
        (s and bytes([s]), e and bytes([e]), bytes([0, n]), 2, 1, n, "x", DAY, "x")
        for n, (s, e) in enumerate(pairs * 4 + [(1, 1)] * 20 + [(None, None)] * 9)
    ]
    raw = spark.createDataFrame(rows, raw.schema)
    known = {n: DAY + timedelta(seconds=n) for n in (1, 2, 4, 5)}
    got = commit_times(raw, times, rows_per_task)
    assert got.columns == [*raw.columns, "start_lsn", "end_lsn"]
    found = {r["AccountID"]: (r.start_lsn, r.end_lsn) for r in got.collect()}
    assert got.count() == len(rows)
    assert found == {
        r[5]: (known.get(r[0] and r[0][0]), known.get(r[1] and r[1][0])) for r in rows
    }


def test_one_lookup_in_the_plan_and_no_job_for_it(spark, tmp_path):
    raw, times = raw_side(spark)
    raw.write.parquet(f"{tmp_path}/raw")
    times.write.parquet(f"{tmp_path}/times")
    raw, times = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("raw", "times"))
    jobs = spark.sparkContext.statusTracker()
    group = "commit-times"
    spark.sparkContext.setJobGroup(group, group)
    joined = transaction_times(raw, times)
    commit_times(raw, times)
    assert not jobs.getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("rest", "rest")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Join") == 1


def index_of(spark, tmp_path):
    return FileIndex(spark, f"{tmp_path}/log", f"{tmp_path}/index", ACCOUNT)


def deliver(spark, tmp_path, *keys):
    rows = [change(n, 2, n, "x") for n in keys] + [change(n, 3, n, "before") for n in keys]
    frame(spark, ACCOUNT, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")


def test_only_files_past_the_mark_are_opened(spark, tmp_path):
    for n in (1, 5, 9):
        deliver(spark, tmp_path, n, n + 1)
    index = index_of(spark, tmp_path)
    assert index.refresh() == 3 and index.refresh() == 0
    deliver(spark, tmp_path, 3, 12)  # late rows too
    mark = DAY + timedelta(seconds=6)
    changes = index.changes_after(mark)
    assert len(changes.inputFiles()) == 2
    assert sorted(r.account_id for r in changes.collect()) == [9, 10, 12]
    assert index.changes_after(mark, before_images=True).count() == 6
    assert len(index.changes_after(DAY).inputFiles()) == 4
    last = index.changes_after(DAY + timedelta(seconds=12))
    assert not last.inputFiles() and last.count() == 0
    plain = changes_after(spark.read.parquet(f"{tmp_path}/log"), mark)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, changes.collect()))


def test_an_index_takes_up_changed_and_lost_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sources.file_index.MERGE_AT", 2)
    monkeypatch.setattr("tidemark.sources.file_index.PATHS_AT_ONCE", 2)
    index = index_of(spark, tmp_path)
    deliver(spark, tmp_path, 1)
    assert index.refresh() == 1
    for n in range(2, 7):
        deliver(spark, tmp_path, n)
    assert index.refresh() == 5
    assert index._parts()[0].endswith("-all") and len(index._parts()) == 1
    assert index.newer_files(DAY + timedelta(seconds=3)) is None  # too many to name
    assert index.changes_after(DAY + timedelta(seconds=3)).count() == 3
    gone = index.newer_files(DAY + timedelta(seconds=5))[0].removeprefix("file:")
    Path(gone).unlink()
    assert index.changes_after(DAY + timedelta(seconds=5)).count() == 0
    first = frame(spark, ACCOUNT, [change(50, 2, 50, "rewritten")])
    kept = index.files().orderBy("low").first()["path"].removeprefix("file:")
    first.coalesce(1).write.parquet(f"{tmp_path}/other")
    Path(kept).write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    Path(kept).with_name(f".{Path(kept).name}.crc").unlink()
    assert index.refresh() == 1
    assert [r.account_id for r in index.changes_after(DAY + timedelta(seconds=9)).collect()] == [50]


def test_an_index_serves_as_a_log(spark, tmp_path):
    store = TargetStore(spark, f"{tmp_path}/target")
    index = index_of(spark, tmp_path)
    for n in (1, 4):
        deliver(spark, tmp_path, n, n + 1)
        run_cycle(store, {"a": index.changes_after}, {"a": ACCOUNT}, default=DAY)
    assert store.read(ACCOUNT).count() == 4


def test_adhoc_query(spark):
    assert query_frame(spark, "SELECT current_timestamp() AS now").count() == 1
    df = query_frame(spark, "SELECT max(note) AS m FROM {t}", t=frame(spark, ACCOUNT, []))
    assert df.first()["m"] is None


def test_connection_comes_from_the_configuration(spark):
    spark.conf.set("spark.tidemark.src.url", "jdbc:sqlserver://example")
    spark.conf.set("spark.tidemark.src.user", "reader")
    assert jdbc.connection(spark, "src") == {
        "url": "jdbc:sqlserver://example",
        "user": "reader",
    }


def test_predicates_of_a_poll():
    mark = DAY + timedelta(microseconds=1999)
    assert jdbc.position_query(mark).startswith("SELECT min(")
    assert jdbc.position_query(mark).endswith("> CAST('2024-03-01 00:00:00.001' AS datetime2(3))")
    assert jdbc.from_position("p", None, []) == ["1 = 0"]
    assert jdbc.from_position("p", bytes([1, 255]), ["k < 5", "k >= 5"]) == [
        "p >= 0x01ff AND (k < 5)",
        "p >= 0x01ff AND (k >= 5)",
    ]


def test_times_that_fall_as_positions_rise_lose_nothing(spark):
    raw, _ = raw_side(spark)
    times = spark.createDataFrame(
        [(bytes([n]), DAY + timedelta(seconds=s)) for n, s in ((1, 1), (2, 9), (3, 2), (5, 1))],
        "lsn binary, commit_time timestamp_ntz",
    )
    read = raw_changes_after(raw, times, ACCOUNT, DAY + timedelta(seconds=2))
    assert [r.start_lsn for r in read.collect()] == [DAY + timedelta(seconds=9)]
    assert raw_changes_after(raw, times, ACCOUNT, DAY + timedelta(seconds=9)).count() == 0


@pytest.mark.parametrize("position", [None, b"\x02", b"\x00"])
def test_slices_hold_every_position_once(spark, position):
    rows = spark.createDataFrame([(bytes([n]),) for n in range(12)] + [(None,)] * 2, "p binary")
    bounds = [bytes([n]) for n in (5, 9, 5, 2, 1)]
    slices = jdbc.position_slices("p", position, bounds, nulls=True)
    parts = [rows.filter(part.replace("0x", "X'").replace(" AND", "' AND") + "'" * ("0x" in part)) for part in slices]
    found = sorted(r.p for part in parts[:-1] for r in part.collect())
    assert found == [bytes([n]) for n in range(12) if position is None or bytes([n]) >= position]
    assert parts[-1].count() == 2
    assert jdbc.position_slices("p", None, []) == ["p IS NOT NULL"]
    assert jdbc.position_slices("p", b"\x07", [b"\x07", b"\x03"]) == ["p >= 0x07"]


def test_a_poll_reads_a_source_once(spark, tmp_path, monkeypatch):
    """Rows that change after the read change nothing; the database is a stand-in."""
    raw, times = raw_side(spark)
    asked, read = [], []

    def answer(session, name, sql):
        asked.append(sql)
        if "NTILE" in sql:
            return spark.createDataFrame([(bytes([n]),) for n in (2, 4, 4)], "p binary")
        none = "23:59" in sql
        return spark.createDataFrame([(None if none else bytes([2]),)], "lsn binary")

    def table(session, name, table_name, predicates):
        read.append((table_name, predicates))
        renamed = times.withColumnsRenamed({"lsn": "start_lsn", "commit_time": "tran_end_time"})
        return renamed if table_name == jdbc.LSN_TIMES else raw

    monkeypatch.setattr(jdbc, "read_query", answer)
    monkeypatch.setattr(jdbc, "read_table", table)
    poll = jdbc.change_log(spark, "src", ACCOUNT)
    changes = poll(DAY + timedelta(seconds=1))
    assert sorted(r.account_id for r in changes.collect()) == [2, 5] and changes.count() == 2
    slices = ["{0} >= 0x02 AND {0} < 0x04", "{0} >= 0x04"]
    assert read == [
        ("cdc.SalesLT_account_CT", [s.format("[__$start_lsn]") for s in slices]),
        ("cdc.lsn_time_mapping", [s.format("start_lsn") for s in slices]),
    ]
    assert len(asked) == 2 and "NTILE(8) OVER (ORDER BY [__$start_lsn])" in asked[1]
    assert poll(DAY + timedelta(hours=23, minutes=59)).count() == 0 and len(read) == 2
    images = jdbc.change_log(spark, "src", ACCOUNT, before_images=True)(DAY)
    assert sorted(r.account_id for r in images.collect()) == [1, 2, 4, 5]


def test_names_and_timeout_of_a_source(spark):
    spark.conf.set("spark.tidemark.other.url", "jdbc:x")
    assert jdbc._login(spark, "other")["loginTimeout"] == "30"
    assert jdbc.source_change_table(spark, "other", ACCOUNT) == "cdc.SalesLT_account_CT"
    for name, value in (("timeout", "5"), ("schema", "Shop"), ("pattern", "ct.{schema}.{table}")):
        spark.conf.set(f"spark.tidemark.other.{name}", value)
    assert jdbc._login(spark, "other")["loginTimeout"] == "5"
    assert jdbc.source_change_table(spark, "other", ACCOUNT) == "ct.Shop.account"


def test_names_that_operators_use_are_refused():
    for columns in ("k long, batch_no int", "k long, __image string", "k long, K int", "k long, seqval string"):
        with pytest.raises(ValueError, match="taken or repeated"):
            define_table("t", columns)
    define_table("t", "k long, found string, image string, touched int, newest int, deleted int")
