"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it has more rows than a task should hold, whatever the total.
ROWS_PER_TASK = 1_000_000
# The hottest so many are joined apart; the others are in the plain join, where
# adaptive execution splits what is still uneven.
MAX_HOT_KEYS = 1_000


# Bits for each changed key, so that one of 16 other keys at most is taken for changed,
# and the bits of a bitmap that is broadcast at most (64 MB).
BITS_PER_KEY, MAX_BITS = 16, 1 << 29
PAGE_BITS = 1 << 15  # of Spark's bitmap aggregates


def fits_broadcast(measured_bytes: int | None) -> bool:
    return measured_bytes is not None and measured_bytes <= BROADCAST_BYTES


def _key_bit(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit("bitmap")), F.lit(bits)) + 1


def key_bitmap(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A bitmap of the keys' hashes as (__page, __bitmap) rows, and its bits in all.

    Its size follows the number of keys, which one narrow pass estimates, up to
    MAX_BITS; with more keys than that it lets more rows through, but never loses one.
    """
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = PAGE_BITS
    while bits < MAX_BITS and bits < BITS_PER_KEY * n:
        bits *= 2
    bit = _key_bit(key, bits)
    pages = keys.filter(F.col(key).isNotNull()).groupBy(
        F.bitmap_bucket_number(bit).alias("__page")
    )
    return pages.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bitmap")), bits


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys, and rows that certainly have none.

    The bitmap is broadcast, so no row moves.  Rows without key have none.
    """
    keys = keys.select(F.col(key).try_cast(rows.schema[key].dataType).alias(key))
    bitmap, bits = key_bitmap(keys, key)
    bit = _key_bit(key, bits)
    place = F.bitmap_bit_position(bit)
    paged = rows.withColumn("__page", F.when(F.col(key).isNotNull(), F.bitmap_bucket_number(bit)))
    paged = paged.join(F.broadcast(bitmap), "__page", "left")
    byte = F.substring("__bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    may = F.coalesce(F.getbit(value, (place % 8).cast("int")) == 1, F.lit(False))
    return paged.filter(may).select(*rows.columns), paged.filter(~may).select(*rows.columns)


def hot_keys(df: DataFrame, key: str, rows_per_task: int) -> list:
    """The hottest keys, NULL included, with more rows than a task should hold.

    Counts are reduced before the shuffle, only the key column is read, and at
    most ``MAX_HOT_KEYS`` values come to the driver.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_task)
    found = counts.orderBy(F.desc("n")).limit(MAX_HOT_KEYS).collect()
    return [bytes(row[0]) if isinstance(row[0], bytearray) else row[0] for row in found]


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Left join to a side that holds each key once.

    With a measured small right side this is a broadcast join and the left side
    is not shuffled.  Otherwise hot keys are looked for first, in ``keys`` if the
    left side is dear to compute.  Without any, it is a plain join.  With some,
    their left rows and those without key stay where they are and meet a
    broadcast of the at most ``MAX_HOT_KEYS`` right rows of the hot keys; all
    other rows are joined plainly.  Each row is in one part by its key alone.
    """
    if fits_broadcast(right_bytes):
        return left.join(F.broadcast(right), key, "left")
    hot = hot_keys(left if keys is None else keys, key, rows_per_task)
    if not hot:
        return left.join(right, key, "left")

    values = [F.lit(value) for value in hot if value is not None]
    is_hot = F.col(key).isin(values) if values else F.lit(False)
    rest = left.filter(F.col(key).isNotNull() & ~is_hot).join(right, key, "left")
    apart = left.filter(F.col(key).isNull() | is_hot)
    return rest.unionByName(apart.join(F.broadcast(right.filter(is_hot)), key, "left"))
