"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default ceiling for an explicit broadcast. Above it the side is left to the
# planner (AQE still converts to a broadcast when runtime statistics allow,
# otherwise sort-merge with skew splitting).
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if ``df`` provably has at most ``max_rows`` rows.

    The check is ``limit(max_rows + 1).count()``: it stops scanning as soon as
    the bound is exceeded, and on a bare parquet scan it is answered from
    footers. When the bound fails the frame is returned unhinted, so the join
    falls back to a shuffle join instead of exhausting executor memory.
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows (scans at most ``max_rows + 1``)."""
    return df.limit(max_rows + 1).count() <= max_rows
