"""Continuous polling with Structured Streaming.

The checkpoint keeps track of what was read, so progress does not depend on the
commit time and rows are never read twice.  The watermark is still recorded.
A query keeps the mark at which it took the table over, and every one of its batches
starts past it, so cycles, other streams and this one may follow each other over
logs and files that overlap.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import BEFORE_IMAGE, DEFAULT_WATERMARK, TableConfig
from tidemark.functions import floor_ms
from tidemark.sinks.targets import TargetStore
from tidemark.sources.change_log import changes_after

EVERY_FIVE_MINUTES = {"processingTime": "5 minutes"}
ALL_AVAILABLE = {"availableNow": True}


def change_stream(
    spark: SparkSession, landing: str, table: TableConfig, **options: str
) -> DataFrame:
    """Changes from files landing in a folder.

    One trigger takes all new files, unless ``maxFilesPerTrigger`` says
    otherwise; ``cleanSource`` keeps the folder from growing for ever.
    """
    return spark.readStream.schema(table.stage_schema).options(**options).parquet(landing)


def stream_apply(
    store: TargetStore,
    landing: str,
    table: TableConfig,
    checkpoint: str,
    trigger: dict | None = None,
    default: datetime = DEFAULT_WATERMARK,
    exact: bool = False,
    **options: str,
) -> StreamingQuery:
    """Apply each micro-batch to the target table, exactly once.

    A query is known by its own id, which lives in its checkpoint, not by the
    checkpoint's path.  It takes a table over at the table's mark, or at ``default`` if
    that has none, cut to milliseconds unless ``exact``, as a cycle reads.  The mark is
    committed with the query's id, and all its batches are read from there: a file that
    comes late but is newer than the mark counts, one that repeats what was applied
    before does not.
    """

    def apply(batch: DataFrame, batch_no: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        state = store.state(table)
        mark = state.source_mark if state.source == query else state.last_update
        mark = default if mark is None else mark
        changes = changes_after(batch, mark if exact else floor_ms(mark))
        store.apply(
            table, changes, source=query, source_batch=batch_no, source_mark=mark, state=state
        )

    return (
        change_stream(store.spark, landing, table, **options)
        .filter(F.col("operation") != BEFORE_IMAGE)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_FIVE_MINUTES))
        .start()
    )


def stream_tables(
    store: TargetStore,
    landing: str,
    tables: Iterable[TableConfig],
    checkpoint: str,
    trigger: dict | None = None,
    default: datetime = DEFAULT_WATERMARK,
    exact: bool = False,
    **options: str,
) -> list[StreamingQuery]:
    """One query per table, each with its own folder and its own progress."""
    return [
        stream_apply(
            store,
            f"{landing}/{t.name}",
            t,
            f"{checkpoint}/{t.name}",
            trigger,
            default,
            exact,
            **options,
        )
        for t in tables
    ]


def stream_stage(
    spark: SparkSession,
    landing: str,
    table: TableConfig,
    stage: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Append every change, before-images included, to a stage table."""
    return (
        change_stream(spark, landing, table, **options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stage)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_FIVE_MINUTES))
        .start()
    )
