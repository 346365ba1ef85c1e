"""Intermediate tables of an operator, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir


class Scratch:
    """Parquet tables below one fresh folder of ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor costs the tasks of the
    next step only.  ``drop`` frees tables that no later step reads; what a
    result still reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = work_dir(spark, purpose)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def save_seen(self, df: DataFrame, name: str, **seen: Column) -> tuple[DataFrame, dict]:
        """``save``, with the number of rows ``n`` and other aggregates taken from the write,
        so that no further job reads the table for them."""
        found = Observation()
        asked = [F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in seen.items())]
        saved = self.save(df.observe(found, *asked), name)
        return saved, found.get

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            folder = jvm.org.apache.hadoop.fs.Path(self.path(name))
            folder.getFileSystem(conf).delete(folder, True)
