"""Change logs without dates in their layout: which files hold commit times past a mark.

    <index>/<n>           rows for the files that were new at refresh n
    <index>/<n>-all       the rows of all files so far

A row is a file's path, length and time of change with its lowest and highest commit
time.  A refresh lists the log and reads one column of the files it does not know, so
a poll opens new files only, however long the log is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import TableConfig
from tidemark.functions import ntz
from tidemark.sinks.files import Folder
from tidemark.sources.change_log import changes_after

ROW = (
    "path string, length long, modified timestamp, low timestamp_ntz, high timestamp_ntz, "
    "n_rows long"
)
FILE = ["path", "length", "modified"]
MERGE_AT = 32  # refreshes after which their rows are written together
PATHS_AT_ONCE = 10_000  # files that are named in one scan


def _one_spelling(path: Column) -> Column:
    """A path without authority may begin with one or three slashes."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):///", "$1:/")


class FileIndex:
    """Lowest and highest commit time of each file of a parquet log."""

    def __init__(self, spark: SparkSession, log: str, index: str, table: TableConfig):
        self.spark, self.log, self.table = spark, log, table
        self.folder = Folder(spark, index)
        self.folder.make()

    def _parts(self) -> list[str]:
        """Folders that count: the last with all rows, and those after it."""
        names = sorted(self.folder.names(""), key=lambda name: int(name.partition("-")[0]))
        whole = [i for i, name in enumerate(names) if name.endswith("-all")]
        return names[whole[-1] if whole else 0 :]

    def files(self) -> DataFrame:
        """What is known of the files, the last of each path."""
        parts = [f"{self.folder.root}/{name}" for name in self._parts()]
        if not parts:
            return self.spark.createDataFrame([], ROW)
        known = self.spark.read.schema(ROW).parquet(*parts)
        newest = F.max_by(F.struct(*known.columns), "modified").alias("file")
        return known.groupBy("path").agg(newest).select("file.*")

    def _listing(self) -> DataFrame:
        """Files of the log; their content is not read."""
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(self.log)
        )
        path = _one_spelling(F.col("path")).alias("path")
        return found.select(path, "length", F.col("modificationTime").alias("modified"))

    def _times(self, paths: list[str]) -> DataFrame:
        """Rows for some files, or for all if none is named."""
        reader = self.spark.read.schema(self.table.stage_schema)
        reader = reader.option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
        rows = reader.parquet(*(paths or [self.log]))
        encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
        file = [
            _one_spelling(F.url_decode(encoded)).alias("path"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modified"),
        ]
        return rows.select(*file, "start_lsn").groupBy(*FILE).agg(
            F.min("start_lsn").alias("low"),
            F.max("start_lsn").alias("high"),
            F.count("*").alias("n_rows"),
        )

    def refresh(self) -> int:
        """Take up the files that are new or were written anew; returns their number."""
        parts = self._parts()
        last = int(parts[-1].partition("-")[0]) if parts else 0
        if not parts:
            self._times([]).write.parquet(f"{self.folder.root}/1-all")
            return self.files().count()
        known = self.files()
        new = [r["path"] for r in self._listing().join(known, FILE, "left_anti").collect()]
        for start in range(0, len(new), PATHS_AT_ONCE):
            last += 1
            rows = self._times(new[start : start + PATHS_AT_ONCE])
            rows.coalesce(1).write.parquet(f"{self.folder.root}/{last}")
        if len(self._parts()) > MERGE_AT:
            rows = self.files().join(self._listing().select("path"), "path", "left_semi")
            rows.repartition(1 + rows.count() // 1_000_000).write.parquet(
                f"{self.folder.root}/{last + 1}-all"
            )
        return len(new)

    def newer_files(self, mark: datetime) -> list[str] | None:
        """Files with a commit time past the mark, or None if they are all of them, or too
        many to name; a scan of the whole log then prunes by its own statistics."""
        files = self.files().join(self._listing().select("path"), "path", "left_semi")
        newer = files.filter(F.col("high") > ntz(mark)).select("path")
        found = [row["path"] for row in newer.limit(PATHS_AT_ONCE + 1).collect()]
        if len(found) > PATHS_AT_ONCE or (found and len(found) == files.count()):
            return None
        return sorted(found)

    def changes_after(self, mark: datetime, before_images: bool = False) -> DataFrame:
        """Changes past the mark, as of the files there are now; a log for ``run_cycle``."""
        self.refresh()
        paths = self.newer_files(mark)
        reader = self.spark.read.schema(self.table.stage_schema)
        if paths is None:
            changes = reader.option("recursiveFileLookup", "true").parquet(self.log)
        elif paths:
            changes = reader.option("ignoreMissingFiles", "true").parquet(*paths)
        else:
            changes = self.spark.createDataFrame([], self.table.stage_schema)
        return changes_after(changes, mark, before_images)
