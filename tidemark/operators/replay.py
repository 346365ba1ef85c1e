"""Applying many batches: one after the other, or a whole history as one job.

Going batch by batch rewrites the target each time and grows the plan, so a
backfill should replay its history; both give the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidemark.config import TableConfig
from tidemark.operators import type1, versioned
from tidemark.session import cut_lineage


def apply_batches(target: DataFrame, batches: list[DataFrame], table: TableConfig) -> DataFrame:
    """One batch after the other; each result is written before it is used."""
    step = versioned.apply_batch if table.versioned else type1.apply_batch
    return reduce(lambda rows, batch: cut_lineage(step(rows, batch, table)), batches, target)


def replay(
    target: DataFrame, history: DataFrame, table: TableConfig, history_bytes: int | None = None
) -> DataFrame:
    """``history`` holds all batches, numbered from 1 by ``batch_no``."""
    step = versioned.apply_history if table.versioned else type1.apply_history
    return step(target, history, table, history_bytes)
