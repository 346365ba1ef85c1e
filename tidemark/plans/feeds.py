"""Change feeds derived from the given tables, whole, for the registered queries.

Each feed has the five change columns and then its table's columns.  Every
after-image comes with its before-image, on the same sequence value.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import BEFORE_IMAGE, SALES_TABLES, TableConfig, define_table
from tidemark.functions import ntz

# Fixed values of the fixtures.
FEED_START = datetime(2023, 12, 31)
CYCLE_START = datetime(1900, 1, 1)
SEED_DATE = datetime(2023, 12, 31)
FIRST_DAY, LAST_DAY = datetime(2024, 1, 1), datetime(2024, 1, 29)
OVERLAP_START = datetime(2024, 1, 5)
BATCH_STARTS = [datetime(2024, 1, 8), datetime(2024, 1, 15), datetime(2024, 1, 22)]
FIRST_CYCLE_ENDS = {
    "dim_address": datetime(2024, 1, 15),
    "dim_customer": datetime(2024, 1, 15),
    "dim_customer_address": datetime(2024, 1, 15),
    "dim_region": datetime(2024, 1, 15),
    "fact_sales_order_detail": datetime(1998, 7, 1),
    "fact_sales_order_header": datetime(1998, 7, 1),
}
CUSTOMER_MARK = datetime(2024, 1, 7, 23, 57, 10, 275269)

CUSTOMER_BALANCE = define_table(
    "customer_balance",
    "customer_id long, segment string, balance double, modified_date timestamp",
)
REGION = SALES_TABLES["dim_region"]
CUSTOMER_VERSIONS = define_table(
    "customer_versions",
    "customer_id long, segment string, balance double, modified_date timestamp",
    versioned=True,
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batch_number(ts: Column) -> Column:
    first, second, third = (ntz(t) for t in BATCH_STARTS)
    return F.when(ts < first, 1).when(ts < second, 2).when(ts < third, 3).otherwise(4)


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number.cast("long")), digits, "0")


def _with_before_images(operation: Column) -> Column:
    both = F.array(F.lit(3), F.lit(4))
    return F.explode(F.when(operation == 4, both).otherwise(F.array(operation)))


def _changes(df: DataFrame, ts: Column, table: TableConfig, **columns: Column) -> DataFrame:
    """Stage-form rows from a frame that has ``seq`` and ``operation``."""
    values = [
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.row_schema.fields
    ]
    return df.select(
        ts.alias("start_lsn"),
        F.lit(None).cast("timestamp_ntz").alias("end_lsn"),
        F.concat(F.lit("0x"), F.col("seq")).alias("seqval"),
        F.col("operation").cast("int").alias("operation"),
        F.lit(1).alias("command_id"),
        *values,
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    operation = F.when(e % 20 == 0, 1).when(e % 20 <= 6, 2).otherwise(4)
    return load(spark, sf_dir, "events").select(
        "*",
        _hex(e, 20).alias("seq"),
        (F.col("user_id") * 15 + F.expr("event_id div 20") % 15).alias("k"),
        _with_before_images(operation).alias("operation"),
    )


def customer_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 feed: about a third of its keys are not customers yet."""
    balance = F.col("value") - F.when(F.col("operation") == BEFORE_IMAGE, 1.0).otherwise(0.0)
    return _changes(
        _events(spark, sf_dir),
        F.col("ts"),
        CUSTOMER_BALANCE,
        customer_id=F.col("k"),
        segment=F.col("event_type"),
        balance=balance,
        modified_date=F.col("ts"),
    )


def customer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        ntz(SEED_DATE).alias("modified_date"),
        F.lit(False).alias("is_deleted"),
    )


def region_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned feed: 50 keys, and day-long version dates, so dates tie."""
    e = F.col("event_id")
    operation = F.when(e % 200 == 0, 1).when(e % 3 == 0, 2).otherwise(4)
    events = load(spark, sf_dir, "events").select(
        "*", _hex(e, 20).alias("seq"), _with_before_images(operation).alias("operation")
    )
    return _changes(
        events,
        F.col("ts"),
        REGION,
        region_id=F.col("user_id") % 50,
        region_name=F.col("event_type"),
        modified_date=F.col("ts").cast("date"),
    )


def region_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("region_id"),
        F.col("n_name").alias("region_name"),
        ntz(SEED_DATE).alias("modified_date"),
        F.lit(False).alias("is_deleted"),
        F.lit(True).alias("is_current"),
    )


def numbered(feed: DataFrame) -> DataFrame:
    """A feed without before-images, with the number of the batch each row is in."""
    return feed.filter(F.col("operation") != BEFORE_IMAGE).withColumn(
        "batch_no", batch_number(F.col("start_lsn"))
    )


def batch(feed: DataFrame, number: int) -> DataFrame:
    return numbered(feed).filter(F.col("batch_no") == number).drop("batch_no")


def lsn_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log positions, twice the event number, with their commit times."""
    return load(spark, sf_dir, "events").select(
        F.unhex(_hex(F.col("event_id") * 2, 20)).alias("lsn"), F.col("ts").alias("commit_time")
    )


def raw_customer_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change table as the source spells it.  Errors sit on unknown (odd)
    positions; only sign-ups have an end position."""
    unknown = F.when(F.col("event_type") == "error", 1).otherwise(0)
    position = F.unhex(_hex(F.col("event_id") * 2 + unknown, 20))
    return _events(spark, sf_dir).select(
        position.alias("__$start_lsn"),
        F.when(F.col("event_type") == "signup", position).alias("__$end_lsn"),
        F.unhex("seq").alias("__$seqval"),
        F.col("operation").alias("__$operation"),
        F.lit(1).alias("__$command_id"),
        F.col("k").alias("CustomerID"),
        F.col("event_type").alias("Segment"),
        F.col("value").alias("Balance"),
        F.col("ts").alias("ModifiedDate"),
    )


def raw_address_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.col("ts").alias("start_lsn"),
        F.lit(None).cast("timestamp_ntz").alias("end_lsn"),
        F.unhex("seq").alias("__$seqval"),
        F.col("operation").alias("__$operation"),
        F.lit(1).alias("__$command_id"),
        F.col("k").alias("AddressID"),
        F.concat(F.lit("Line "), F.col("event_id")).alias("AddressLine1"),
        F.lit(None).cast("string").alias("AddressLine2"),
        F.concat(F.lit("City "), F.col("user_id")).alias("City"),
        F.col("event_type").alias("StateProvince"),
        F.lit("NATION").alias("CountryRegion"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("PostalCode"),
        _guid(F.col("event_id")).alias("rowguid"),
        F.col("ts").alias("ModifiedDate"),
        F.col("props").alias("Unconfigured"),
    )


# -- the six configured tables ------------------------------------------------


def _guid(number: Column) -> Column:
    return F.concat(
        F.lit("00000000-0000-0000-0000-"), F.lpad(number.cast("string"), 12, "0")
    )


def _address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(
        _events(spark, sf_dir),
        F.col("ts"),
        SALES_TABLES["dim_address"],
        address_id=F.col("k"),
        address_line1=F.concat(F.lit("Line "), F.col("event_id")),
        city=F.concat(F.lit("City "), F.col("user_id")),
        state_province=F.col("event_type"),
        rowguid=_guid(F.col("event_id")),
        modified_date=F.col("ts"),
    )


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(
        _events(spark, sf_dir),
        F.col("ts"),
        SALES_TABLES["dim_customer"],
        customer_id=F.col("k"),
        first_name=F.concat(F.lit("First"), F.col("user_id")),
        last_name=F.concat(F.lit("Last"), F.col("event_id")),
        company_name=F.col("event_type"),
        rowguid=_guid(F.col("event_id")),
        modified_date=F.col("ts"),
    )


def _customer_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(
        _events(spark, sf_dir),
        F.col("ts"),
        SALES_TABLES["dim_customer_address"],
        customer_address_id=F.col("k"),
        customer_id=F.col("user_id"),
        address_id=F.col("event_id"),
        address_type=F.col("event_type"),
        rowguid=_guid(F.col("event_id")),
        modified_date=F.col("ts"),
    )


def _days(ts: Column) -> Column:
    return F.datediff(ts, F.lit("1995-01-01").cast("date"))


def _order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per line item: returned and closed lines are deletes."""
    operation = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1)
        .when(F.col("l_linestatus") == "O", 2)
        .otherwise(4)
    )
    lines = load(spark, sf_dir, "lineitem").select(
        "*",
        F.concat(
            _hex(_days(F.col("l_shipdate")), 4),
            _hex(F.col("l_partkey"), 10),
            _hex(F.col("l_suppkey"), 6),
        ).alias("seq"),
        _with_before_images(operation).alias("operation"),
    )
    price = F.col("l_extendedprice").cast("decimal(19,4)")
    quantity = F.col("l_quantity").cast("int")
    return _changes(
        lines,
        F.col("l_shipdate"),
        SALES_TABLES["fact_sales_order_detail"],
        sales_order_detail_id=F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        sales_order_id=F.col("l_orderkey"),
        order_qty=quantity,
        product_id=F.col("l_partkey"),
        unit_price=price,
        unit_price_discount=F.col("l_discount"),
        line_total=price * quantity,
        rowguid=_guid(F.col("l_partkey")),
        modified_date=F.col("l_shipdate"),
    )


def _order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders are inserted, pending ones updated a week later, finished
    ones deleted a month later."""
    status = F.col("o_orderstatus")
    operations = (
        F.when(status == "O", F.array(F.lit(2)))
        .when(status == "P", F.array(F.lit(2), F.lit(3), F.lit(4)))
        .otherwise(F.array(F.lit(2), F.lit(1)))
    )
    orders = load(spark, sf_dir, "orders").select("*", F.explode(operations).alias("operation"))
    op = F.col("operation")
    delay = F.when(op == 2, 0).when(op == 1, 30).otherwise(7)
    orders = orders.withColumn("changed", F.timestamp_add("DAY", delay, F.col("o_orderdate")))
    orders = orders.withColumn(
        "seq", F.concat(_hex(_days(F.col("changed")), 4), _hex(F.col("o_orderkey"), 16))
    )
    return _changes(
        orders,
        F.col("changed"),
        SALES_TABLES["fact_sales_order_header"],
        sales_order_id=F.col("o_orderkey"),
        revision_number=F.when(op == 2, 1).otherwise(2),
        order_date=F.col("o_orderdate"),
        status=F.when(op == 4, 5).otherwise(1),
        online_order_flag=F.col("o_orderpriority") == "5-LOW",
        sales_order_number=F.concat(F.lit("SO"), F.col("o_orderkey")),
        customer_id=F.col("o_custkey"),
        sub_total=F.col("o_totalprice"),
        total_due=F.col("o_totalprice"),
        rowguid=_guid(F.col("o_orderkey")),
        modified_date=F.col("changed"),
    )


SALES_FEEDS = {
    "dim_address": _address,
    "dim_customer": _customer,
    "dim_customer_address": _customer_address,
    "dim_region": region_ct,
    "fact_sales_order_detail": _order_detail,
    "fact_sales_order_header": _order_header,
}
