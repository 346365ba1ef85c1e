"""The command line, on logs of every layout."""

from datetime import datetime

import pytest
from model import DAY, change, frame

from tidemark import __main__ as command
from tidemark.config import table_config
from tidemark.plans.logs import LogPlace
from tidemark.sinks.stage import read_polls, read_stage
from tidemark.sinks.targets import TargetStore
from tidemark.sources import jdbc

REGION = table_config("dim_region")
SINCE = ["--since", "2000-01-01", "--table", "dim_region"]


@pytest.fixture(autouse=True)
def session(spark, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda: spark)


def deliver(spark, tmp_path, first, last):
    rows = [change(n, 3 if n % 4 == 0 else 2, n, f"r{n}", n) for n in range(first, last + 1)]
    rows = frame(spark, REGION, rows)
    rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/logs/dim_region")


def versions(spark, tmp_path):
    return TargetStore(spark, f"{tmp_path}/out").read(REGION).count()


def run(name, tmp_path, *more):
    command.main([name, "--root", f"{tmp_path}/out", *SINCE, *more])


@pytest.mark.parametrize("more", [[], ["--no-reread"], ["--exact"], ["--index", "INDEX"]])
def test_cycle(spark, tmp_path, more):
    more = [f"{tmp_path}/index" if m == "INDEX" else m for m in more]
    for first, last, found in ((1, 5, 4), (6, 9, 7)):
        deliver(spark, tmp_path, first, last)
        run("cycle", tmp_path, "--logs", f"{tmp_path}/logs", *more)
        assert versions(spark, tmp_path) == found
    run("cycle", tmp_path, "--logs", f"{tmp_path}/logs", *more)
    assert versions(spark, tmp_path) == 7


def test_since(spark, tmp_path):
    deliver(spark, tmp_path, 1, 5)
    since = ["--since", str(DAY.replace(second=2)), "--table", "dim_region"]
    command.main(["cycle", "--root", f"{tmp_path}/out", *since, "--logs", f"{tmp_path}/logs"])
    assert versions(spark, tmp_path) == 2


def test_dated_and_raw_logs(spark, tmp_path):
    rows = frame(spark, REGION, [change(n, 2, n, "x", n) for n in range(1, 4)])
    dated = rows.selectExpr("*", "CAST(start_lsn AS DATE) AS day")
    dated.write.partitionBy("day").parquet(f"{tmp_path}/dated/dim_region")
    run("cycle", tmp_path, "--logs", f"{tmp_path}/dated", "--dates", "day")
    assert versions(spark, tmp_path) == 3
    raw = spark.createDataFrame(
        [(bytes([n]), None, bytes([n]), 2, 1, n, "y", DAY) for n in (5, 6)],
        "`__$start_lsn` binary, `__$end_lsn` binary, `__$seqval` binary, `__$operation` int, "
        "`__$command_id` int, RegionID long, RegionName string, ModifiedDate timestamp_ntz",
    )
    raw.write.parquet(f"{tmp_path}/raw/dim_region")
    times = [(bytes([n]), DAY.replace(second=n)) for n in (5, 6)]
    spark.createDataFrame(times, "lsn binary, commit_time timestamp_ntz").write.parquet(f"{tmp_path}/times")
    run("cycle", tmp_path, "--logs", f"{tmp_path}/raw", "--times", f"{tmp_path}/times")
    assert versions(spark, tmp_path) == 5


def test_stream_and_maintain(spark, tmp_path):
    deliver(spark, tmp_path, 1, 5)
    for _ in range(2):
        run("stream", tmp_path, "--logs", f"{tmp_path}/logs", "--once")
    assert versions(spark, tmp_path) == 4
    command.main(["maintain", "--root", f"{tmp_path}/out", "--table", "dim_region", "--vacuum", "0"])
    assert versions(spark, tmp_path) == 4


@pytest.mark.parametrize("index", [False, True])
def test_appended_stage(spark, tmp_path, index):
    more = ["--index", f"{tmp_path}/index"] if index else []
    for first, last in ((1, 5), (6, 9)):
        deliver(spark, tmp_path, first, last)
        run("stage", tmp_path, "--logs", f"{tmp_path}/logs", "--append", *more)
    found = read_polls(spark, f"{tmp_path}/out/dim_region", REGION).collect()
    assert sorted((r.region_id, r.poll) for r in found) == [(n, 1 + (n > 5)) for n in range(1, 10)]


def test_replaced_stage_goes_to_a_database(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(jdbc, "write_table", lambda rows, *args: written.append((rows.count(), rows.columns, *args)))
    deliver(spark, tmp_path, 1, 5)
    run("stage", tmp_path, "--logs", f"{tmp_path}/logs", "--to-database", "target")
    assert read_stage(spark, f"{tmp_path}/out/dim_region", REGION).count() == 4
    assert written == [(4, REGION.stage_schema.fieldNames(), "target", "stage.dim_region", True)]


def test_query_is_checked_first(spark, tmp_path, monkeypatch):
    asked = []

    def answer(session, name, sql):
        asked.append((name, sql))
        return spark.createDataFrame([(1,)], "ok int")

    monkeypatch.setattr(jdbc, "read_query", answer)
    command.main(["query", "--database", "src", "--sql", "SELECT x", "--out", f"{tmp_path}/out"])
    assert asked == [("src", "SELECT 1 AS ok"), ("src", "SELECT x")]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    monkeypatch.setattr(jdbc, "read_query", lambda *a: spark.createDataFrame([], "ok int"))
    with pytest.raises(RuntimeError, match="no answer"):
        jdbc.precheck(spark, "src")


def test_a_log_has_one_place():
    for wrong in ({}, {"logs": "a", "database": "b"}, {"database": "b", "dates": "d"}, {"logs": "a", "dates": "d", "index": "i"}):
        with pytest.raises(ValueError, match="a log is dated|give a folder|a database has no"):
            LogPlace(**wrong)
    assert LogPlace(logs="a", index="i").index == "i" and datetime.min < DAY
