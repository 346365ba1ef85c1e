"""Where the change logs of a poll come from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import TableConfig
from tidemark.plans.cycle import ChangeLog
from tidemark.sources import jdbc
from tidemark.sources.change_log import changes_after, raw_changes_after
from tidemark.sources.file_index import FileIndex


@dataclass(frozen=True)
class LogPlace:
    """One of: a source database, or a folder with a parquet log per table, which is in
    stage form, dated by a partition column, raw with its times beside it, or indexed.
    """

    logs: str | None = None
    database: str | None = None
    dates: str | None = None  # the partition column with the commit date
    times: str | None = None  # the folder of log positions and commit times of raw logs
    index: str | None = None  # the folder of file indexes

    def __post_init__(self) -> None:
        if (self.logs is None) == (self.database is None):
            raise ValueError("give a folder of logs or a database")
        if self.database and (self.dates or self.times or self.index):
            raise ValueError("a database has no dates, times or index folders")
        if sum(x is not None for x in (self.dates, self.times, self.index)) > 1:
            raise ValueError("a log is dated, raw or indexed")

    def log(
        self, spark: SparkSession, table: TableConfig, before_images: bool = False
    ) -> ChangeLog:
        """The log as it is, or a function of the mark; ``before_images`` is for the latter."""
        if self.database:
            return jdbc.change_log(spark, self.database, table, before_images=before_images)
        path = f"{self.logs}/{table.name}"
        if self.index:
            index = FileIndex(spark, path, f"{self.index}/{table.name}", table)
            return partial(index.changes_after, before_images=before_images)
        if self.times:
            return self._raw(spark, table, path, before_images)
        log = spark.read.schema(table.stage_schema).parquet(path)
        if not self.dates:
            return log
        dated = spark.read.option("basePath", path).parquet(path)

        def newer(mark: datetime) -> DataFrame:
            return changes_after(dated, mark, before_images, self.dates)

        return newer

    def _raw(
        self, spark: SparkSession, table: TableConfig, path: str, before_images: bool
    ) -> ChangeLog:
        def newer(mark: datetime) -> DataFrame:
            raw, times = spark.read.parquet(path), spark.read.parquet(self.times)
            return raw_changes_after(raw, times, table, mark, before_images)

        return newer
