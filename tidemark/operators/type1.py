"""Type-1 apply: one row per key, overwritten whole, deletes only flagged.

Rules that a plain "last operation wins" merge would get wrong:

* a delete wins over any insert of its key in the same batch, whatever their order;
* the deleted flag is never reset: a later insert refreshes the columns only;
* a delete of a key the target does not hold is lost;
* an image overwrites every column, NULLs included.

The result of any number of batches depends only on three facts per key: its
latest image, the first batch with an image, and the last batch with a delete.
So a history of batches is one aggregate and one join; a single batch is a
history of length one.  ``batch_no`` counts from 1, target rows are batch 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import TableConfig
from tidemark.operators.changes import IMAGE_ORDER, is_delete, is_row_image, required_key
from tidemark.operators.joins import fits_broadcast, split_by_keys


def net_changes(history: DataFrame, table: TableConfig) -> DataFrame:
    """One row per key: ``__image`` (NULL if none), ``__first_image``, ``__last_delete``.

    One shuffle of at most one row per key and input task, however hot a key is.
    The columns follow the order inside the struct, so even full ties are
    decided the same way on every run.
    """
    image = F.struct("batch_no", *IMAGE_ORDER, *table.columns[1:])
    return (
        history.filter(F.col(table.key).isNotNull())
        .groupBy(table.key)
        .agg(
            F.max(F.when(is_row_image(), image)).alias("__image"),
            F.min(F.when(is_row_image(), F.col("batch_no"))).alias("__first_image"),
            F.max(F.when(is_delete(), F.col("batch_no"))).alias("__last_delete"),
        )
    )


def merge(
    target: DataFrame,
    changes: DataFrame,
    table: TableConfig,
    changes_bytes: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Merge net changes into the target.

    Both sides hold a key once, so the hash partitions of the full outer join
    are even.  With few changes the target is not shuffled at all: updates are
    a broadcast left join, and inserts are the changes whose key is not among
    the matched ones.  With more, and the ``keys`` of the changes to tell them by, only
    target rows whose key may have changed are shuffled.
    """
    key = table.key
    if keys is not None and not fits_broadcast(changes_bytes):
        merged, rest = merge_apart(target, changes, table, keys)
        return merged.unionByName(rest)
    rows = target.withColumn("__in_target", F.lit(True))
    if fits_broadcast(changes_bytes):
        matched = target.select(key).join(F.broadcast(changes), key, "left_semi")
        inserts = changes.join(F.broadcast(matched), key, "left_anti")
        joined = rows.join(F.broadcast(changes), key, "left").unionByName(
            inserts, allowMissingColumns=True
        )
    else:
        joined = rows.join(changes, key, "full_outer")

    has_image = F.col("__image").isNotNull()
    created = F.when(F.col("__in_target"), F.lit(0)).otherwise(F.col("__first_image"))

    def value(column: str) -> Column:
        return F.when(has_image, F.col("__image")[column]).otherwise(F.col(column)).alias(column)

    return joined.filter(F.col("__in_target") | has_image).select(
        key,
        *[value(c) for c in table.columns[1:]],
        (
            F.coalesce("is_deleted", F.lit(False))
            | F.coalesce(F.col("__last_delete") >= created, F.lit(False))
        ).alias("is_deleted"),
    )


def merge_apart(
    target: DataFrame, changes: DataFrame, table: TableConfig, keys: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """What ``merge`` gives, in two parts: rows whose key may have changed, and the
    target's other rows, which stay where they are."""
    target, untouched = split_by_keys(target, keys, table.key)
    deleted = F.coalesce("is_deleted", F.lit(False)).alias("is_deleted")
    return merge(target, changes, table), untouched.select(*table.columns, deleted)


def _keyed(history: DataFrame, table: TableConfig) -> DataFrame:
    return history.withColumn(table.key, required_key(table))


def apply_history_apart(
    target: DataFrame, history: DataFrame, table: TableConfig
) -> tuple[DataFrame, DataFrame]:
    """``apply_history`` of a history too large to broadcast, in the parts of ``merge_apart``."""
    history = _keyed(history, table)
    return merge_apart(target, net_changes(history, table), table, history.select(table.key))


def apply_to_none(target: DataFrame, history: DataFrame, table: TableConfig) -> DataFrame:
    """``apply_history`` to a target without rows: no keys to tell rows by."""
    return merge(target, net_changes(_keyed(history, table), table), table)


def apply_history(
    target: DataFrame, history: DataFrame, table: TableConfig, history_bytes: int | None = None
) -> DataFrame:
    """Target after all batches of a history with a ``batch_no`` column.

    ``history_bytes`` is the measured size of the history; net changes are never
    larger, so it decides whether they may be broadcast.  An image without key
    stops the job; a delete without key matches nothing.
    """
    history = _keyed(history, table)
    keys = history.select(table.key)
    return merge(target, net_changes(history, table), table, history_bytes, keys)


def apply_batch(
    target: DataFrame, batch: DataFrame, table: TableConfig, batch_bytes: int | None = None
) -> DataFrame:
    """Target after one batch: upsert of the latest images, then soft delete."""
    return apply_history(target, batch.withColumn("batch_no", F.lit(1)), table, batch_bytes)


def upsert(target: DataFrame, batch: DataFrame, table: TableConfig) -> DataFrame:
    """The upsert step alone."""
    return apply_batch(target, batch.filter(is_row_image()), table)


def soft_delete(target: DataFrame, keys: DataFrame, table: TableConfig) -> DataFrame:
    """The delete step alone, for distinct keys."""
    touched, untouched = split_by_keys(target, keys, table.key)
    marked = touched.join(keys.withColumn("__found", F.lit(True)), table.key, "left")
    deleted = F.coalesce("is_deleted", F.lit(False))
    return marked.select(
        *table.columns, (deleted | F.col("__found").isNotNull()).alias("is_deleted")
    ).unionByName(untouched.select(*table.columns, deleted.alias("is_deleted")))
