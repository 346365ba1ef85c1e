"""Column expressions shared by the operators; all of them JVM built-ins."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sequence_hex(binary: Column) -> Column:
    """Binary sequence value as ``0x…`` text, whose order is the binary order."""
    return F.concat(F.lit("0x"), F.hex(binary))


def commit_time_ms(ts: Column) -> Column:
    """Commit time cut (not rounded) to milliseconds.

    ``date_trunc`` would go through the session time zone; taking off the part
    below a millisecond does not.
    """
    below_ms = F.extract(F.lit("SECOND"), ts) % F.lit(Decimal("0.001"))
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, below_ms)


def floor_ms(time: datetime) -> datetime:
    """The same cut for a time in the driver."""
    return time.replace(microsecond=time.microsecond // 1000 * 1000)


def ntz(value: datetime) -> Column:
    """A zone-less timestamp literal, whatever the time zone of driver and session."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def row_bytes(schema: T.StructType) -> Column:
    """Upper estimate of one row's size in memory."""
    fixed = F.lit(24 * len(schema.fields)).cast("long")
    texts = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        for f in schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return reduce(lambda a, b: a + b, texts, fixed)
