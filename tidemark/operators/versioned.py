"""Versioned apply: every image becomes a row; a batch decides which are current.

* a delete flags every version of its key, those of the same batch included;
* versions appended by later batches start undeleted;
* for each key seen in a batch, by any operation, exactly the versions dated at
  the batch's highest version date of that key are current.  Ties give several
  current versions, no match gives none.

So after any number of batches a version is deleted if its key was deleted in
the version's batch or later, and only the last batch of a key decides what is
current: one small per-key summary and one lookup.  ``batch_no`` counts from 1,
target rows are batch 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import TableConfig
from tidemark.operators.changes import is_delete, row_images
from tidemark.operators.joins import fits_broadcast, left_lookup, split_by_keys


def append_versions(
    target: DataFrame, batch: DataFrame, table: TableConfig, *extra: str
) -> DataFrame:
    """All images of the batch as further rows, not only the latest of a key."""
    images = row_images(batch).select(
        *table.columns,
        F.lit(False).alias("is_deleted"),
        F.lit(False).alias("is_current"),
        *extra,
    )
    return target.unionByName(images)


def key_summary(history: DataFrame, table: TableConfig) -> DataFrame:
    """Per key: highest version date of its last batch, and last batch with a delete.

    Two steps: the large one is a hash aggregate of plain columns with partial
    sums before the shuffle, the second sees one row per key and batch.
    """
    per_batch = (
        history.filter(F.col(table.key).isNotNull())
        .groupBy(table.key, "batch_no")
        .agg(F.max(table.version_column).alias("__newest"), F.max(is_delete()).alias("__deleted"))
    )
    return per_batch.groupBy(table.key).agg(
        F.max(F.struct("batch_no", "__newest"))["__newest"].alias("__newest"),
        F.max(F.when(F.col("__deleted"), F.col("batch_no"))).alias("__last_delete"),
        F.lit(True).alias("__touched"),
    )


def apply_history(
    target: DataFrame, history: DataFrame, table: TableConfig, history_bytes: int | None = None
) -> DataFrame:
    """Target after all batches of a history with a ``batch_no`` column.

    A history measured as small is broadcast.  Of any other, only versions whose key may
    be in it are shuffled, by a lookup that spreads hot keys; the rest stay where they
    are, as no batch says anything of them.
    """
    untouched = None
    if not fits_broadcast(history_bytes):
        target, untouched = split_by_keys(target, history.select(table.key), table.key)
    versions = append_versions(target.withColumn("batch_no", F.lit(0)), history, table, "batch_no")
    joined = left_lookup(versions, key_summary(history, table), table.key, history_bytes)
    is_newest = F.coalesce(F.col(table.version_column) == F.col("__newest"), F.lit(False))
    applied = joined.select(
        *table.columns,
        (
            _is_deleted() | F.coalesce(F.col("__last_delete") >= F.col("batch_no"), F.lit(False))
        ).alias("is_deleted"),
        F.when(F.col("__touched"), is_newest).otherwise(F.col("is_current")).alias("is_current"),
    )
    if untouched is None:
        return applied
    return applied.unionByName(
        untouched.select(*table.columns, _is_deleted().alias("is_deleted"), "is_current")
    )


def _is_deleted() -> Column:
    return F.coalesce("is_deleted", F.lit(False))


def _changed(
    target: DataFrame, changes: DataFrame, table: TableConfig, deleted: Column, current: Column
) -> DataFrame:
    """Target with flags from a lookup; versions of other keys are not shuffled."""
    touched, untouched = split_by_keys(target, changes.select(table.key), table.key)
    found = left_lookup(touched, changes, table.key).select(
        *table.columns, deleted.alias("is_deleted"), current.alias("is_current")
    )
    return found.unionByName(untouched.select(found.columns))


def apply_batch(
    target: DataFrame, batch: DataFrame, table: TableConfig, batch_bytes: int | None = None
) -> DataFrame:
    """Target after one batch: append, soft delete, reset and set current."""
    return apply_history(target, batch.withColumn("batch_no", F.lit(1)), table, batch_bytes)


def soft_delete(target: DataFrame, keys: DataFrame, table: TableConfig) -> DataFrame:
    """The delete step alone, on all versions of the given distinct keys."""
    deleted = _is_deleted() | F.col("__found").isNotNull()
    target = target.withColumn("is_deleted", _is_deleted())
    keys = keys.withColumn("__found", F.lit(True))
    return _changed(target, keys, table, deleted, F.col("is_current"))


def _batch_summary(batch: DataFrame, table: TableConfig) -> DataFrame:
    return key_summary(batch.withColumn("batch_no", F.lit(1)), table)


def reset_current(target: DataFrame, batch: DataFrame, table: TableConfig) -> DataFrame:
    """Clear the current flag on every version of every key in the batch."""
    touched = _batch_summary(batch, table).select(table.key, "__touched")
    current = F.col("is_current") & F.col("__touched").isNull()
    return _changed(target, touched, table, F.col("is_deleted"), current)


def set_current(target: DataFrame, batch: DataFrame, table: TableConfig) -> DataFrame:
    """Set the current flag where a version has the batch's highest date of its key."""
    newest = _batch_summary(batch, table).select(table.key, "__newest")
    is_newest = F.col(table.version_column) == F.col("__newest")
    current = F.when(is_newest, F.lit(True)).otherwise(F.col("is_current"))
    return _changed(target, newest, table, F.col("is_deleted"), current)
