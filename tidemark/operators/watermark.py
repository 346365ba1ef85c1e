"""High-water marks: the last applied commit time of each table.

By default a mark is cut to milliseconds when it is looked up while the scan
keeps commit times strictly above it, so rows of the last partial millisecond
are read again by the next poll.  ``exact=True`` compares in microseconds.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_WATERMARK
from tidemark.functions import commit_time_ms, ntz

REGISTRY_SCHEMA = "table_name string, last_update timestamp_ntz"


def _mark(ts: Column, default: datetime, exact: bool) -> Column:
    mark = F.coalesce(ts, ntz(default))
    return mark if exact else commit_time_ms(mark)


def lookup_watermarks(
    registry: DataFrame,
    tables: list[str],
    default: datetime = DEFAULT_WATERMARK,
    exact: bool = False,
) -> DataFrame:
    """Mark of each named table; a NULL mark or a missing row gives the default."""
    spark = registry.sparkSession
    names = F.array(*[F.lit(t) for t in tables])
    wanted = spark.range(0, 1, 1, 1).select(F.explode(names).alias("table_name"))
    # one row per configured table at most
    known = F.broadcast(registry.filter(F.col("table_name").isin(tables)))
    return wanted.join(known, "table_name", "left").select(
        "table_name", _mark(F.col("last_update"), default, exact).alias("last_update")
    )


def watermark_of_stage(
    stage: DataFrame, default: datetime = DEFAULT_WATERMARK, exact: bool = False
) -> DataFrame:
    """Mark taken from the data itself: always one row."""
    return stage.agg(_mark(F.max("start_lsn"), default, exact).alias("last_update"))


def batch_mark(batch: DataFrame) -> DataFrame:
    """Row count and newest commit time over all operations of the batch."""
    return batch.agg(F.count("*").alias("n_rows"), F.max("start_lsn").alias("last_update"))


def advance_watermark(registry: DataFrame, batch: DataFrame, table_name: str) -> DataFrame:
    """Registry after the batch; an empty batch leaves it as it is.

    The new mark replaces the old one even if it is lower.  The batch is read once.
    """
    new = (
        batch_mark(batch)
        .filter("n_rows > 0")
        .select(F.lit(table_name).alias("table_name"), "last_update", F.lit(1).alias("age"))
    )
    return (
        registry.withColumn("age", F.lit(0))
        .unionByName(new)
        .groupBy("table_name")
        .agg(F.max_by("last_update", "age").alias("last_update"))
    )


