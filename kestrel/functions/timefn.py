"""Time helpers as Column expressions (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slot_start(ts: Column | str, seconds: int) -> Column:
    """Start of the fixed ``seconds``-wide slot containing ``ts`` (timestamp_ntz).

    Unlike ``window()`` it can be used several times in one projection.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds) \
        .cast("timestamp_ntz")


def add_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def iso_seconds(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
