"""Lookups stay right and balanced when keys are hot or NULL."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_BYTES, left_lookup, split_by_keys


def sides(spark):
    """4000 rows: half of them on key 1, a quarter without key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 2 == 0, 1).when(n % 4 == 1, F.lit(None)).otherwise(n)
    left = spark.range(4000).select(key.cast("long").alias("k"), n.alias("row"))
    right = spark.range(0, 3000, 1).select(F.col("id").alias("k"), (n * 10).alias("v"))
    return left, right


def rows(df):
    return Counter(tuple(r) for r in df.select("k", "row", "v").collect())


def test_lookup_equals_plain_join(spark):
    left, right = sides(spark)
    want = rows(left.join(right, "k", "left"))
    assert rows(left_lookup(left, right, "k")) == want
    assert rows(left_lookup(left, right, "k", rows_per_task=10)) == want
    assert rows(left_lookup(left, right, "k", right_bytes=BROADCAST_BYTES)) == want
    assert rows(left_lookup(left, right, "k", right_bytes=BROADCAST_BYTES + 1)) == want


def partition_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("equal_rows", [False, True])
def test_hot_key_is_spread(spark, equal_rows):
    left, right = sides(spark)
    left = left.repartition(8)
    if equal_rows:
        left = left.withColumn("row", F.lit(0))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",  # 500 rows each if even
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plain = partition_sizes(left.join(right, "k", "left"))
        spread = partition_sizes(left_lookup(left, right, "k", rows_per_task=50))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert plain[-1] >= 2000
    assert spread[-1] < 1000
    assert sum(spread) == sum(plain) == 4000


def test_binary_and_null_hot_keys(spark):
    left, right = sides(spark)
    left, right = (df.withColumn("k", F.col("k").cast("string").cast("binary")) for df in (left, right))
    want = Counter(tuple(map(str, r)) for r in left.join(right, "k", "left").collect())
    found = left_lookup(left, right, "k", rows_per_task=50)
    assert Counter(tuple(map(str, r)) for r in found.collect()) == want
    only_null = left.withColumn("k", F.lit(None).cast("binary"))
    assert left_lookup(only_null, right, "k", rows_per_task=50).filter("v IS NULL").count() == 4000


def test_rows_are_split_by_changed_keys(spark, monkeypatch):
    left, _ = sides(spark)
    keys = spark.createDataFrame([(1,), (7,), (None,), (99_999,)], "k long")
    may, other = split_by_keys(left, keys, "k")
    assert {r.k for r in other.collect()}.isdisjoint({1, 7})
    assert {1, 7} <= {r.k for r in may.collect()} and may.count() + other.count() == 4000
    assert may.filter("k IS NULL OR k > 7").count() < 100  # others by chance only
    none, all_rows = split_by_keys(left, keys.limit(0), "k")
    assert none.count() == 0 and all_rows.count() == 4000
    monkeypatch.setattr("tidemark.operators.joins.MAX_BITS", 1)  # keeps to the least size
    many = spark.range(40_000).select(F.col("id").alias("k"))
    may, other = split_by_keys(left, many, "k")
    assert other.filter("k IS NOT NULL").count() == 0


def test_keys_of_another_type_are_found(spark):
    rows = spark.range(100).select(F.col("id").cast("int").alias("k"))
    may, _ = split_by_keys(rows, spark.createDataFrame([(5,), (2**40,)], "k long"), "k")
    assert may.count() == 1
    texts = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    may, _ = split_by_keys(texts, spark.createDataFrame([("a",)], "k string"), "k")
    assert [r.k for r in may.collect()] == ["a"]
