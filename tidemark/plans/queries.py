"""The registered queries: each operator over whole tables of the test data."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SALES_TABLES, TableConfig
from tidemark.functions import commit_time_ms, ntz, sequence_hex
from tidemark.operators import changes, replay, type1, versioned, watermark
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.plans import feeds
from tidemark.plans.cycle import compact_tables, run_cycle, summarize
from tidemark.plans.feeds import CUSTOMER_BALANCE, CUSTOMER_VERSIONS, REGION
from tidemark.session import cut_lineage, work_dir
from tidemark.sinks.stage import append_poll, merge_polls, read_polls, read_stage, replace_stage
from tidemark.sinks.targets import TargetStore
from tidemark.sources.change_log import (
    changes_after,
    project_changes,
    raw_changes_after,
    read_raw_changes,
)
from tidemark.sources.file_index import FileIndex
from tidemark.sources.query import query_frame
from tidemark.streaming.poll import ALL_AVAILABLE, stream_apply, stream_stage

Query = Callable[[SparkSession, str], DataFrame]

BATCH_NUMBERS = range(1, len(feeds.BATCH_STARTS) + 2)
COMPACT_BATCHES = 2  # so that the few batches of these queries include compactions
BUCKET_BYTES = 1 << 23  # and several buckets

ADHOC_SQL = """
    SELECT segment, operation, count(*) AS n_changes,
           count(DISTINCT customer_id) AS n_customers, max(start_lsn) AS last_change
    FROM {changes}
    GROUP BY segment, operation
"""


def _polled(feed: DataFrame) -> DataFrame:
    """A feed as one poll that starts before its first row."""
    return changes_after(feed, feeds.FEED_START)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers were applied up to batch 1; regions are listed, but without a mark."""
    first = feeds.batch(feeds.customer_ct(spark, sf_dir), 1)
    unmarked = spark.createDataFrame([("dim_region", None)], watermark.REGISTRY_SCHEMA)
    return watermark.advance_watermark(unmarked, first, "dim_customer")


# -- scans and projections ------------------------------------------------------


def watermark_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.lookup_watermarks(_registry(spark, sf_dir), list(SALES_TABLES))


def watermark_from_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.watermark_of_stage(feeds.customer_ct(spark, sf_dir))


def watermark_truncate_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.load(spark, sf_dir, "events").select(
        "event_id", commit_time_ms(F.col("ts")).alias("ts_ms")
    )


def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a mark, one with an empty batch, and one not listed yet."""
    customers, regions = feeds.customer_ct(spark, sf_dir), feeds.region_ct(spark, sf_dir)
    polls = [
        ("dim_customer", _polled(customers)),
        ("dim_region", regions.filter(F.col("start_lsn") < ntz(feeds.FEED_START))),
        ("dim_address", _polled(regions)),
    ]
    return reduce(
        lambda registry, poll: watermark.advance_watermark(registry, poll[1], poll[0]),
        polls,
        _registry(spark, sf_dir),
    )


def batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.batch_mark(_polled(feeds.customer_ct(spark, sf_dir)))


def change_scan_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = watermark.lookup_watermarks(
        _registry(spark, sf_dir), ["dim_customer"], feeds.FEED_START
    )
    return changes_after(
        feeds.customer_ct(spark, sf_dir), mark.select("last_update").scalar()
    )


def change_scan_all_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_after(
        feeds.customer_ct(spark, sf_dir), feeds.FEED_START, before_images=True
    )


def adhoc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_frame(spark, ADHOC_SQL, changes=feeds.customer_ct(spark, sf_dir))


def lsn_to_commit_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_changes(
        feeds.raw_customer_ct(spark, sf_dir), feeds.lsn_times(spark, sf_dir), CUSTOMER_BALANCE
    )


def change_scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental scan of a raw change table, mark and all."""
    mark = watermark.lookup_watermarks(_registry(spark, sf_dir), ["dim_customer"])
    return raw_changes_after(
        feeds.raw_customer_ct(spark, sf_dir),
        feeds.lsn_times(spark, sf_dir),
        CUSTOMER_BALANCE,
        mark.first()["last_update"],
    )


def change_scan_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental scan of a growing log without dates, by an index of its files."""
    path = work_dir(spark, "file-index")
    index = FileIndex(spark, f"{path}/log", f"{path}/index", CUSTOMER_BALANCE)
    numbered = feeds.customer_ct(spark, sf_dir).withColumn(
        "number", feeds.batch_number(F.col("start_lsn"))
    )
    for number in BATCH_NUMBERS:
        delivery = numbered.filter(F.col("number") == number).drop("number")
        delivery.write.mode("append").parquet(f"{path}/log")
        index.refresh()
    mark = watermark.lookup_watermarks(_registry(spark, sf_dir), ["dim_customer"])
    return index.changes_after(mark.first()["last_update"])


def seqval_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.raw_customer_ct(spark, sf_dir).select(
        F.col("CustomerID").alias("customer_id"),
        sequence_hex(F.col("`__$seqval`")).alias("seqval"),
    )


def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_changes(feeds.raw_address_ct(spark, sf_dir), SALES_TABLES["dim_address"])


# -- reductions of a batch ------------------------------------------------------


def upsert_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.row_images(feeds.customer_ct(spark, sf_dir))


def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.deleted_keys(feeds.customer_ct(spark, sf_dir), CUSTOMER_BALANCE)


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_images(feeds.customer_ct(spark, sf_dir), CUSTOMER_BALANCE)


def max_modified_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.newest_per_key(_polled(feeds.region_ct(spark, sf_dir)), REGION)


# -- stage tables -----------------------------------------------------------------


def stage_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four polls of a growing log; each finds its mark in what was appended before."""
    feed = feeds.customer_ct(spark, sf_dir)
    path = work_dir(spark, "stage-append")
    for poll, end in enumerate([*feeds.BATCH_STARTS, None], start=1):
        log = feed if end is None else feed.filter(F.col("start_lsn") < ntz(end))
        append_poll(spark, path, log, CUSTOMER_BALANCE, poll, feeds.FEED_START)
    return read_polls(spark, path, CUSTOMER_BALANCE).drop("poll")


def stage_append_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A poll for each day, with merging in between; the log is as if there were none."""
    feed = feeds.customer_ct(spark, sf_dir)
    path = work_dir(spark, "stage-merged")
    days = (feeds.LAST_DAY - feeds.FIRST_DAY).days
    for poll in range(1, days + 2):
        visible = feed.filter(F.col("start_lsn") < ntz(feeds.FIRST_DAY + timedelta(days=poll)))
        log = visible if poll <= days else feed
        append_poll(spark, path, log, CUSTOMER_BALANCE, poll, feeds.FEED_START, exact=True)
        merge_polls(spark, path, CUSTOMER_BALANCE)
    return read_polls(spark, path, CUSTOMER_BALANCE).drop("poll")


def stage_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load replaces the first."""
    feed, path = feeds.customer_ct(spark, sf_dir), work_dir(spark, "stage-replace")
    for batch in (feeds.batch(feed, 1), _polled(feed)):
        replace_stage(batch, path, CUSTOMER_BALANCE)
    return read_stage(spark, path, CUSTOMER_BALANCE)


# -- type-1 apply -----------------------------------------------------------------


def upsert_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _polled(feeds.customer_ct(spark, sf_dir))
    return type1.upsert(feeds.customer_seed(spark, sf_dir), batch, CUSTOMER_BALANCE)


def soft_delete_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = delete_keys(spark, sf_dir)
    return type1.soft_delete(feeds.customer_seed(spark, sf_dir), keys, CUSTOMER_BALANCE)


def apply_type1_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _polled(feeds.customer_ct(spark, sf_dir))
    return type1.apply_batch(feeds.customer_seed(spark, sf_dir), batch, CUSTOMER_BALANCE)


def successive_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.customer_ct(spark, sf_dir)
    batches = [feeds.batch(feed, n) for n in BATCH_NUMBERS]
    return replay.apply_batches(feeds.customer_seed(spark, sf_dir), batches, CUSTOMER_BALANCE)


def replay_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = feeds.numbered(feeds.customer_ct(spark, sf_dir))
    return replay.replay(feeds.customer_seed(spark, sf_dir), history, CUSTOMER_BALANCE)


# -- versioned apply --------------------------------------------------------------


def _regions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return feeds.region_seed(spark, sf_dir), _polled(feeds.region_ct(spark, sf_dir))


def versioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versioned.append_versions(*_regions(spark, sf_dir), REGION)


def versioned_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed, batch = _regions(spark, sf_dir)
    versions = versioned.append_versions(seed, batch, REGION)
    return versioned.soft_delete(versions, changes.deleted_keys(batch, REGION), REGION)


def versioned_reset_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed, batch = _regions(spark, sf_dir)
    versions = versioned.append_versions(seed, batch, REGION)
    return versioned.reset_current(versions, batch, REGION)


def versioned_set_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed, batch = _regions(spark, sf_dir)
    versions = versioned.append_versions(seed, batch, REGION)
    return versioned.set_current(versions, batch, REGION)


def apply_versioned_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versioned.apply_batch(*_regions(spark, sf_dir), REGION)


def successive_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.region_ct(spark, sf_dir)
    batches = [feeds.batch(feed, n) for n in BATCH_NUMBERS]
    return replay.apply_batches(feeds.region_seed(spark, sf_dir), batches, REGION)


def versioned_large_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch too large to broadcast over many versions, of which few keys change."""
    feed = feeds.customer_ct(spark, sf_dir)
    seed = feeds.customer_seed(spark, sf_dir).withColumn("is_current", F.lit(True))
    history = feeds.numbered(feed).filter(F.col("batch_no") < BATCH_NUMBERS[-1])
    versions = replay.replay(seed, history, CUSTOMER_VERSIONS)
    target = cut_lineage(versions)
    last = feeds.batch(feed, BATCH_NUMBERS[-1])
    return versioned.apply_batch(target, last, CUSTOMER_VERSIONS, BROADCAST_BYTES + 1)


def replay_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = feeds.numbered(feeds.region_ct(spark, sf_dir))
    return replay.replay(feeds.region_seed(spark, sf_dir), history, REGION)


# -- cycles over several tables ---------------------------------------------------


def _two_cycles(
    spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(SALES_TABLES)
) -> TargetStore:
    """One cycle over the first part of the tables' logs, one over the rest; after each,
    compaction of the buckets it touched."""
    names = list(names)
    store = TargetStore(spark, work_dir(spark, "cycle"), bucket_bytes=BUCKET_BYTES)
    customer = SALES_TABLES["dim_customer"]
    if customer.name in names:
        empty = spark.createDataFrame([], customer.target_schema)
        store.seed(customer, empty, feeds.CUSTOMER_MARK)
    if REGION.name in names:
        store.seed(REGION, feeds.region_seed(spark, sf_dir))
    logs = {name: feeds.SALES_FEEDS[name](spark, sf_dir) for name in names}
    first = {
        name: log.filter(F.col("start_lsn") < ntz(feeds.FIRST_CYCLE_ENDS[name]))
        for name, log in logs.items()
    }
    for available in (first, logs):
        run_cycle(store, available, default=feeds.CYCLE_START)
        compact_tables(store, [SALES_TABLES[name] for name in names])
    return store


def _cycle_of(name: str) -> Query:
    """Every row and column of one target after two cycles."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _two_cycles(spark, sf_dir, [name]).read(SALES_TABLES[name])

    query.__name__ = f"cycle_{name}"
    return query


def multi_table_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(_two_cycles(spark, sf_dir), list(SALES_TABLES.values()))


def multi_table_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the six targets, in one common shape."""
    store = _two_cycles(spark, sf_dir)

    def rows(table: TableConfig) -> DataFrame:
        label = "region_name" if table.versioned else "rowguid"
        current = F.col("is_current") if table.versioned else F.lit(True)
        return store.read(table).select(
            F.lit(table.name).alias("table_name"),
            F.col(table.key).alias("row_key"),
            F.col(label).alias("label"),
            "modified_date",
            "is_deleted",
            current.alias("is_current"),
        )

    return reduce(DataFrame.unionByName, [rows(t) for t in SALES_TABLES.values()])


def versioned_no_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls whose marks are cut to milliseconds, without a version stored twice."""
    store = TargetStore(spark, work_dir(spark, "no-reread"))
    store.seed(REGION, feeds.region_seed(spark, sf_dir))
    feed = feeds.region_ct(spark, sf_dir)
    for end in (*feeds.BATCH_STARTS, None):
        log = feed if end is None else feed.filter(F.col("start_lsn") < ntz(end))
        run_cycle(store, {REGION.name: log}, default=feeds.FEED_START, no_reread=True)
    return store.read(REGION)


# -- streams ----------------------------------------------------------------------


def _deliver_and_apply(
    spark: SparkSession, feed: DataFrame, seed: DataFrame, table: TableConfig
) -> DataFrame:
    """Four deliveries of files, and a run of the stream after each."""
    path = work_dir(spark, "stream-apply")
    store = TargetStore(spark, f"{path}/target", compact_batches=COMPACT_BATCHES)
    store.seed(table, seed)
    for number in BATCH_NUMBERS:
        delivery = feed.filter(feeds.batch_number(F.col("start_lsn")) == number)
        delivery.write.mode("append").parquet(f"{path}/landing")
        stream_apply(
            store,
            f"{path}/landing",
            table,
            f"{path}/checkpoint",
            ALL_AVAILABLE,
            default=feeds.FEED_START,
        ).awaitTermination()
    return store.read(table)


def stream_apply_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, seed = feeds.customer_ct(spark, sf_dir), feeds.customer_seed(spark, sf_dir)
    return _deliver_and_apply(spark, feed, seed, CUSTOMER_BALANCE)


def stream_apply_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, seed = feeds.region_ct(spark, sf_dir), feeds.region_seed(spark, sf_dir)
    return _deliver_and_apply(spark, feed, seed, REGION)


def cycle_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle over the first batch, then a stream, one file a trigger, over files that
    hold parts of that batch again."""
    path = work_dir(spark, "cycle-stream")
    store = TargetStore(spark, f"{path}/target")
    store.seed(REGION, feeds.region_seed(spark, sf_dir))
    feed = feeds.region_ct(spark, sf_dir)
    batch_no = feeds.batch_number(F.col("start_lsn"))
    run_cycle(store, {REGION.name: feed.filter(batch_no == 1)}, default=feeds.FEED_START)
    recent = F.col("start_lsn") >= ntz(feeds.OVERLAP_START)
    files = [
        feed.filter((batch_no == 2) | ((batch_no == 1) & recent)),
        feed.filter((batch_no == 3) | (batch_no == 1)),
        feed.filter(batch_no == 4),
    ]
    for number, rows in enumerate(files):
        rows.coalesce(1).write.parquet(f"{path}/landing/file={number}")
    stream_apply(
        store,
        f"{path}/landing/*",
        REGION,
        f"{path}/checkpoint",
        ALL_AVAILABLE,
        default=feeds.FEED_START,
        maxFilesPerTrigger="1",
    ).awaitTermination()
    return store.read(REGION)


def stream_stage_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream-stage")
    feeds.customer_ct(spark, sf_dir).write.parquet(f"{path}/landing")
    stream_stage(
        spark,
        f"{path}/landing",
        CUSTOMER_BALANCE,
        f"{path}/stage",
        f"{path}/checkpoint",
        ALL_AVAILABLE,
    ).awaitTermination()
    return spark.read.schema(CUSTOMER_BALANCE.stage_schema).parquet(f"{path}/stage")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        watermark_lookup,
        watermark_from_stage,
        watermark_truncate_ms,
        watermark_upsert,
        batch_count,
        change_scan_incremental,
        change_scan_all_images,
        adhoc_query,
        change_scan_raw,
        change_scan_indexed,
        lsn_to_commit_time,
        seqval_hex,
        rename_project,
        upsert_images,
        delete_keys,
        latest_per_key,
        max_modified_by_key,
        stage_append,
        stage_append_merged,
        stage_replace,
        upsert_type1,
        soft_delete_type1,
        apply_type1_batch,
        successive_type1,
        replay_type1,
        versioned_append,
        versioned_soft_delete,
        versioned_reset_current,
        versioned_set_current,
        apply_versioned_batch,
        successive_versioned,
        replay_versioned,
        versioned_large_batch,
        multi_table_cycle,
        multi_table_targets,
        *map(_cycle_of, SALES_TABLES),
        versioned_no_reread,
        stream_apply_type1,
        stream_apply_versioned,
        cycle_then_stream,
        stream_stage_append,
    ]
}
