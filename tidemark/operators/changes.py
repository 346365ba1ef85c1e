"""Reading a batch of changes: images, deletes, and their per-key reductions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import CHANGE_COLUMNS, DELETE, ROW_IMAGES, TableConfig

# Ties on the sequence value are broken by these, so the choice of the latest
# image never depends on row order or on which task ran first.
IMAGE_ORDER = ["seqval", "start_lsn", "command_id"]


def is_row_image() -> Column:
    return F.col("operation").isin(*ROW_IMAGES)


def required_key(table: TableConfig) -> Column:
    """The key; an image to be stored that has none stops the job."""
    missing = F.col(table.key).isNull() & is_row_image()
    stop = F.raise_error(F.lit(f"{table.name}: image without {table.key}"))
    return F.when(missing, stop).otherwise(F.col(table.key))


def is_delete() -> Column:
    return F.col("operation") == DELETE


def row_images(batch: DataFrame) -> DataFrame:
    return batch.filter(is_row_image())


def deleted_keys(batch: DataFrame, table: TableConfig) -> DataFrame:
    """Distinct keys with a delete; a NULL key can match nothing."""
    return (
        batch.filter(is_delete() & F.col(table.key).isNotNull()).select(table.key).distinct()
    )


def latest_images(batch: DataFrame, table: TableConfig) -> DataFrame:
    """The image with the highest sequence value of each key.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so
    a hot key sends at most one row per input task.  Full ties are decided by the
    columns, in the order in which ``type1.net_changes`` compares them.
    """
    order = [*IMAGE_ORDER, *table.columns[1:], "operation", "end_lsn"]
    newest = Window.partitionBy(table.key).orderBy(*[F.desc(c) for c in order])
    return (
        row_images(batch)
        .withColumn("__image_rank", F.row_number().over(newest))
        .filter("__image_rank = 1")
        .select(*CHANGE_COLUMNS, *table.columns)
    )


def newest_per_key(batch: DataFrame, table: TableConfig) -> DataFrame:
    """Highest version date of each key over all operations of the batch."""
    return batch.groupBy(table.key).agg(
        F.max(table.version_column).alias(f"max_{table.version_column}")
    )
