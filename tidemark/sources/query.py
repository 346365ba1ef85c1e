"""Ad-hoc SQL to a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_frame(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL text over the given frames; ``{name}`` in the text stands for a frame."""
    return spark.sql(sql, **views)
