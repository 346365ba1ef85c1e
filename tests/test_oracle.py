"""Every registered query against its SQL answer, rows and types."""

import pytest
from check import DATA, difference, duck

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.queries import QUERIES

SF = f"{DATA}/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_answer():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(QUERIES) | set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    assert difference(df, con, oracle_sql()[name]) is None
    described = con.execute("DESCRIBE " + oracle_sql()[name]).fetchall()
    want = {row[0]: row[1] for row in described}
    assert {n: TYPES.get(t, t.upper()) for n, t in df.dtypes} == want


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_id", "segment", "balance", "modified_date", "is_deleted"]
    assert df.count() > 0


def test_time_zone_of_the_session_does_not_matter(spark, con):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("watermark_lookup", "watermark_truncate_ms", "replay_versioned"):
            assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
