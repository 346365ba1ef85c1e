"""Live databases over JDBC: change tables in, ad-hoc queries in, tables out.

Address and credentials come from the Spark configuration
(``spark.tidemark.<name>.url|user|password|driver``), never from code; so do the seconds
that a connection may take (``timeout``) and, where they are not the configured ones, the
source's schema and the pattern of its change tables (``schema``, ``pattern``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CHANGE_TABLE_PATTERN, SOURCE_SCHEMA, TableConfig
from tidemark.session import work_dir
from tidemark.sources.change_log import START, changes_after, read_raw_changes

# The source's own table of log positions and commit times.
LSN_TIMES, LSN, COMMIT_TIME = "cdc.lsn_time_mapping", "start_lsn", "tran_end_time"
# Fixed value: the seconds a connection may take.
TIMEOUT = "30"
SLICES = 8


def connection(spark: SparkSession, name: str) -> dict[str, str]:
    prefix = f"spark.tidemark.{name}"
    options = {"url": spark.conf.get(f"{prefix}.url")}
    for part in ("user", "password", "driver"):
        value = spark.conf.get(f"{prefix}.{part}", None)
        if value:
            options[part] = value
    return options


def _login(spark: SparkSession, name: str) -> dict[str, str]:
    timeout = spark.conf.get(f"spark.tidemark.{name}.timeout", TIMEOUT)
    return connection(spark, name) | {"loginTimeout": timeout}


def source_change_table(spark: SparkSession, name: str, table: TableConfig) -> str:
    prefix = f"spark.tidemark.{name}"
    return table.change_table_of(
        spark.conf.get(f"{prefix}.schema", SOURCE_SCHEMA),
        spark.conf.get(f"{prefix}.pattern", CHANGE_TABLE_PATTERN),
    )


def precheck(spark: SparkSession, name: str) -> None:
    """One row from the database, so that a wrong address or login stops the job at once."""
    if read_query(spark, name, "SELECT 1 AS ok").first() is None:
        raise RuntimeError(f"{name}: no answer")


def read_query(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Ad-hoc SQL, run by the database itself."""
    return (
        spark.read.format("jdbc")
        .options(**_login(spark, name), query=sql, preferTimestampNTZ="true")
        .load()
    )


def read_table(
    spark: SparkSession, name: str, table: str, predicates: list[str]
) -> DataFrame:
    """A table, one task per predicate; the database filters."""
    options = _login(spark, name) | {"preferTimestampNTZ": "true", "fetchsize": "10000"}
    return spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)


def position_query(mark: datetime) -> str:
    """First log position after a mark; the source keeps times to the millisecond.

    Times may fall as positions rise, so this is not the one after the last position
    that the mark covers.
    """
    text = mark.isoformat(sep=" ", timespec="milliseconds")
    after = f"{COMMIT_TIME} > CAST('{text}' AS datetime2(3))"
    return f"SELECT min({LSN}) AS lsn FROM {LSN_TIMES} WHERE {after}"


def from_position(column: str, position: bytes | None, slices: list[str]) -> list[str]:
    """Predicates for rows from a position on, one for each slice of the table; without
    a position there are no rows."""
    newer = f"{column} >= 0x{bytes(position).hex()}" if position is not None else "1 = 0"
    return [f"{newer} AND ({part})" for part in slices] or [newer]


def bounds_query(table: str, column: str, position: bytes, slices: int) -> str:
    """First positions of about equal parts of the rows from a position on; the database
    deals them out, so a transaction with very many rows makes its part no shorter
    than itself."""
    dealt = f"SELECT {column} AS p, NTILE({slices}) OVER (ORDER BY {column}) AS slice"
    newer = f"{column} >= 0x{bytes(position).hex()}"
    return f"SELECT min(p) AS p FROM ({dealt} FROM {table} WHERE {newer}) t GROUP BY slice"


def position_slices(
    column: str, position: bytes | None, bounds: list[bytes], nulls: bool = False
) -> list[str]:
    """Predicates that hold each row from a position on exactly once.

    Bounds may repeat and come in any order.  Without a position every row counts, with
    the rest below the first bound; rows without position are a slice of their own if
    wanted.
    """
    cuts = sorted({bytes(b) for b in bounds if position is None or bytes(b) > bytes(position)})
    lows = [position if position is None else bytes(position), *cuts]
    highs = [*cuts, None]
    found = []
    for low, high in zip(lows, highs, strict=True):
        parts = [f"{column} >= 0x{low.hex()}"] if low is not None else []
        parts += [f"{column} < 0x{high.hex()}"] if high is not None else []
        found.append(" AND ".join(parts) or f"{column} IS NOT NULL")
    return [*found, f"{column} IS NULL"] if nulls else found


def change_log(
    spark: SparkSession,
    name: str,
    table: TableConfig,
    slices: int = SLICES,
    before_images: bool = False,
) -> Callable[[datetime], DataFrame]:
    """Change log for ``run_cycle``, read from the source database at each poll.

    The mark is translated once into a log position, and the database sends only rows
    from there on, in slices of about equal size, each a task.  Rows and positions are
    read once, into the shared folder, so that all that follows sees the same rows of a
    table that goes on changing, and the database is not asked again.
    """
    raw_name = source_change_table(spark, name, table)
    column = f"[{START}]"

    def poll(mark: datetime) -> DataFrame:
        position = read_query(spark, name, position_query(mark)).first()["lsn"]
        if position is None:
            return spark.createDataFrame([], table.stage_schema)
        found = read_query(spark, name, bounds_query(raw_name, column, position, slices))
        bounds = [row["p"] for row in found.collect()]  # one per slice
        path = work_dir(spark, "jdbc")
        raw = read_table(spark, name, raw_name, position_slices(column, position, bounds))
        raw.write.parquet(f"{path}/rows")
        times = read_table(spark, name, LSN_TIMES, position_slices(LSN, position, bounds))
        times.select(F.col(LSN).alias("lsn"), F.col(COMMIT_TIME).alias("commit_time")).write.parquet(
            f"{path}/times"
        )
        raw, times = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/times")
        return changes_after(read_raw_changes(raw, times, table), mark, before_images)

    return poll


def write_stage_table(staged: DataFrame, name: str, table: TableConfig, replace: bool) -> None:
    """A batch to the target database's stage table, its columns in stage order."""
    rows = staged.select(*table.stage_schema.fieldNames())
    write_table(rows, name, f"stage.{table.name}", replace)


def write_table(df: DataFrame, name: str, table: str, replace: bool) -> None:
    """Append to a table, or empty it and load it anew, in parallel batches."""
    writer = df.write.format("jdbc").options(
        **_login(df.sparkSession, name), dbtable=table, batchsize="10000"
    )
    if replace:
        writer.option("truncate", "true").mode("overwrite").save()
    else:
        writer.mode("append").save()
