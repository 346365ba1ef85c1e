"""Change logs: from the source's raw change tables to incremental scans."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import BEFORE_IMAGE, CHANGE_COLUMNS, TableConfig, source_column
from tidemark.functions import ntz, sequence_hex
from tidemark.operators.changes import required_key
from tidemark.operators.joins import ROWS_PER_TASK


def check_schema(df: DataFrame, table: TableConfig) -> DataFrame:
    """Fail before any work if a configured column is missing or has another type."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name} {f.dataType.simpleString()}"
        for f in table.stage_schema.fields
        if have.get(f.name.lower()) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{table.name}: missing or of another type: {', '.join(wrong)}")
    return df


START, END = "__$start_lsn", "__$end_lsn"


def transaction_times(raw: DataFrame, lsn_times: DataFrame) -> DataFrame:
    """(START, END, start_lsn, end_lsn, __n): commit times of each pair of positions.

    A pair is one transaction, so there are far fewer than changes.  Its positions are
    unpivoted, met with the position table in one join, and folded back; one that is
    not in the table gives NULL.  ``lsn_times(lsn, commit_time)`` holds a position
    once.  ``__n`` counts the changes, in the pass that finds the pairs.
    """
    pairs = raw.groupBy(START, END).agg(F.count("*").alias("__n"))
    sides = F.array(
        F.struct(F.lit("start").alias("side"), F.col(START).alias("lsn")),
        F.struct(F.lit("end").alias("side"), F.col(END).alias("lsn")),
    )
    sides = pairs.select(START, END, "__n", F.inline(sides)).filter("lsn IS NOT NULL")
    timed = sides.join(lsn_times.select("lsn", "commit_time"), "lsn", "left")
    time_of = {s: F.max(F.when(F.col("side") == s, F.col("commit_time"))) for s in ("start", "end")}
    return timed.groupBy(START, END).agg(
        F.max("__n").alias("__n"),
        time_of["start"].alias("start_lsn"),
        time_of["end"].alias("end_lsn"),
    )


def commit_times(
    raw: DataFrame, lsn_times: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Raw changes with the commit times of their start and end positions.

    A bulk load puts very many changes on one pair of positions.  Pairs with more than
    ``rows_per_task``, of which there are as few as that number fits into the log, are
    broadcast, and their changes stay where they are, like those without any position.
    All others are shuffled once.  No job runs while the plan is built.
    """
    columns = [F.col(f"`{c}`") for c in raw.columns]
    times = transaction_times(raw, lsn_times).withColumnsRenamed({START: "__start", END: "__end"})
    same = F.col(START).eqNullSafe(F.col("__start")) & F.col(END).eqNullSafe(F.col("__end"))
    hot = F.broadcast(times.filter(F.col("__n") > rows_per_task))
    rest = times.filter(F.col("__n") <= rows_per_task)
    placed = raw.filter(F.col(START).isNotNull() | F.col(END).isNotNull())
    null = F.lit(None).cast("timestamp_ntz")
    nowhere = raw.filter(F.col(START).isNull() & F.col(END).isNull()).select(
        *columns, null.alias("start_lsn"), null.alias("end_lsn")
    )
    plain = placed.join(hot.select("__start", "__end"), same, "left_anti").join(rest, same)
    return reduce(
        DataFrame.unionByName,
        [
            plain.select(*columns, "start_lsn", "end_lsn"),
            placed.join(hot, same).select(*columns, "start_lsn", "end_lsn"),
            nowhere,
        ],
    )


def project_changes(raw: DataFrame, table: TableConfig) -> DataFrame:
    """Configured columns only, renamed from the source's spelling, by name."""
    return raw.select(
        "start_lsn",
        "end_lsn",
        sequence_hex(F.col("`__$seqval`")).alias("seqval"),
        F.col("`__$operation`").cast("int").alias("operation"),
        F.col("`__$command_id`").cast("int").alias("command_id"),
        *[
            F.col(source_column(f.name)).cast(f.dataType).alias(f.name)
            for f in table.row_schema.fields
        ],
    )


def read_raw_changes(raw: DataFrame, lsn_times: DataFrame, table: TableConfig) -> DataFrame:
    """A raw change table in stage form, with log positions mapped to commit times."""
    return project_changes(commit_times(raw, lsn_times), table)


def raw_changes_after(
    raw: DataFrame,
    lsn_times: DataFrame,
    table: TableConfig,
    watermark: datetime,
    before_images: bool = False,
) -> DataFrame:
    """Changes of a raw change table committed strictly after the mark.

    The mark is translated once into the first position with a later commit time,
    and that one value prunes both the raw table and the positions to look up.
    Clocks may step back, so positions from there on may still have times up to
    the mark, which the last filter drops.  An end position is never before its
    start.
    """
    first = lsn_times.filter(F.col("commit_time") > ntz(watermark)).agg(F.min("lsn")).first()[0]
    position = F.lit(None if first is None else bytes(first)).cast("binary")
    newer = raw.filter(F.col("__$start_lsn") >= position)
    times = lsn_times.filter(F.col("lsn") >= position)
    return changes_after(read_raw_changes(newer, times, table), watermark, before_images)


def changes_after(
    log: DataFrame,
    watermark: datetime | Column,
    before_images: bool = False,
    date_partition: str | None = None,
) -> DataFrame:
    """Changes committed strictly after the mark, by default without before-images.

    Both filters reach the parquet scan.  For a log partitioned by commit date,
    name that column and older partitions are not read at all.
    """
    mark = watermark if isinstance(watermark, Column) else ntz(watermark)
    changes = log.filter(F.col("start_lsn") > mark)
    if date_partition:
        changes = changes.filter(F.col(date_partition) >= mark.cast("date"))
    if not before_images:
        changes = changes.filter(F.col("operation") != BEFORE_IMAGE)
    return changes


def require_keys(batch: DataFrame, table: TableConfig) -> DataFrame:
    """Stop the batch if an image to be stored has no key."""
    return batch.withColumn(table.key, required_key(table)).select(*CHANGE_COLUMNS, *table.columns)
