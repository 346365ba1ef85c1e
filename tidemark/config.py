"""Table configuration: which tables are replicated, their columns and names.

The first column of every table is its key.  A table is applied either as a
type-1 table (one row per key, latest image wins) or as a versioned dimension
(every image kept, one batch decides which versions are current).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

DELETE, INSERT, BEFORE_IMAGE, AFTER_IMAGE = 1, 2, 3, 4
ROW_IMAGES = (INSERT, AFTER_IMAGE)

# Fixed value: the mark used for a table that has never been applied.
DEFAULT_WATERMARK = datetime(2024, 7, 31, 3, 35, 57, 990000)

# Schema of the replicated source database, and the pattern its
# change-capture feature uses to name change tables.
SOURCE_SCHEMA = "SalesLT"
CHANGE_TABLE_PATTERN = "cdc.{schema}_{table}_CT"

CHANGE_FIELDS = [
    T.StructField("start_lsn", T.TimestampNTZType()),
    T.StructField("end_lsn", T.TimestampNTZType()),
    T.StructField("seqval", T.StringType()),
    T.StructField("operation", T.IntegerType()),
    T.StructField("command_id", T.IntegerType()),
]
CHANGE_COLUMNS = [f.name for f in CHANGE_FIELDS]

# Columns that operators add; a replicated table can have none of these names.
INTERNAL = "__"
RESERVED = ["is_deleted", "is_current", "batch_no", "batch_id", "bucket", "poll", "attempt"]


@dataclass(frozen=True)
class TableConfig:
    name: str
    row_schema: T.StructType
    versioned: bool = False
    version_column: str = "modified_date"

    def __post_init__(self) -> None:
        taken = {*CHANGE_COLUMNS, *RESERVED}
        names = [name.lower() for name in self.columns]
        wrong = [n for n in names if n in taken or n.startswith(INTERNAL) or names.count(n) > 1]
        if wrong:
            raise ValueError(f"{self.name}: column names taken or repeated: {', '.join(wrong)}")

    @property
    def columns(self) -> list[str]:
        return self.row_schema.fieldNames()

    @property
    def key(self) -> str:
        return self.columns[0]

    @property
    def flags(self) -> list[str]:
        return ["is_deleted", "is_current"] if self.versioned else ["is_deleted"]

    @property
    def stage_schema(self) -> T.StructType:
        return T.StructType(CHANGE_FIELDS + self.row_schema.fields)

    @property
    def target_schema(self) -> T.StructType:
        flags = [T.StructField(f, T.BooleanType()) for f in self.flags]
        return T.StructType(self.row_schema.fields + flags)

    @property
    def source_table(self) -> str:
        """Table name at the source: no prefix word, no underscores."""
        return self.name.partition("_")[2].replace("_", "")

    @property
    def change_table(self) -> str:
        return self.change_table_of()

    def change_table_of(
        self, schema: str = SOURCE_SCHEMA, pattern: str = CHANGE_TABLE_PATTERN
    ) -> str:
        """Its change table in a source database of other names."""
        return pattern.format(schema=schema, table=self.source_table)


def source_column(column: str) -> str:
    """Column name at the source; Spark resolves it case-insensitively."""
    return column.replace("_", "")


TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "money": T.DecimalType(19, 4),
    "amount": T.DecimalType(38, 6),
}


def define_table(name: str, columns: str, **options) -> TableConfig:
    """Configure a table from ``"key type, column type, …"``; needs no session."""
    fields = [c.split() for c in columns.split(",")]
    schema = T.StructType([T.StructField(column, TYPES[kind]) for column, kind in fields])
    return TableConfig(name, schema, **options)


# The replicated tables and their columns, key first.
SALES_TABLES = {
    t.name: t
    for t in [
        define_table(
            "dim_address",
            "address_id long, address_line1 string, address_line2 string, city string, "
            "state_province string, country_region string, postal_code string, "
            "rowguid string, modified_date timestamp",
        ),
        define_table(
            "dim_customer",
            "customer_id long, title string, first_name string, middle_name string, "
            "last_name string, suffix string, company_name string, sales_person string, "
            "email_address string, phone string, password_hash string, "
            "password_salt string, rowguid string, modified_date timestamp",
        ),
        define_table(
            "dim_customer_address",
            "customer_address_id long, customer_id long, address_id long, "
            "address_type string, rowguid string, modified_date timestamp",
        ),
        define_table(
            "dim_region",
            "region_id long, region_name string, modified_date timestamp",
            versioned=True,
        ),
        define_table(
            "fact_sales_order_detail",
            "sales_order_detail_id long, sales_order_id long, order_qty int, "
            "product_id long, unit_price money, unit_price_discount money, "
            "line_total amount, rowguid string, modified_date timestamp",
        ),
        define_table(
            "fact_sales_order_header",
            "sales_order_id long, revision_number int, order_date timestamp, "
            "due_date timestamp, ship_date timestamp, status int, "
            "online_order_flag boolean, sales_order_number string, "
            "purchase_order_number string, account_number string, customer_id long, "
            "ship_to_address_id long, bill_to_address_id long, ship_method string, "
            "credit_card_approval_code string, sub_total money, "
            "tax_amt money, freight money, total_due money, "
            "comment string, rowguid string, modified_date timestamp",
        ),
    ]
}


def table_config(name: str) -> TableConfig:
    if name not in SALES_TABLES:
        raise KeyError(f"unknown table {name!r}; configured: {', '.join(SALES_TABLES)}")
    return SALES_TABLES[name]
