"""Aggregates on streams whose windows close by watermark (append mode).

The batch operators (``logs.activity``, ``logs.component_metrics``,
``journeys.session_trips``) run unchanged on a stream whose time column has a
watermark: a window is written once, when the watermark has passed its end.
Repeated deliveries are dropped by a key while the watermark still covers them.

A window that is open when the source ends stays open. A feed that ends sends
a heartbeat, a row later than the last one by more than the delay and the
widest window, which closes all windows before it; its own is never written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import journeys
from kestrel.operators import logs as lg


def timed(df: DataFrame, column: str, delay: str) -> DataFrame:
    """``df`` with the watermark ``delay`` on ``column`` (as a session time zone timestamp)."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """First delivery of each key while the watermark covers it; needs ``timed``."""
    return df.dropDuplicatesWithinWatermark(keys)


def activity(logs: DataFrame, width: str = "30 minutes", delay: str = "1 hour",
             repeated_key: str | None = "correlation_id") -> DataFrame:
    """``logs.activity`` of a stream of parsed lines, each request counted once."""
    rows = timed(logs.select("day", "date_start", "correlation_id"), "date_start", delay)
    return _local(lg.activity(unique(rows, [repeated_key]) if repeated_key else rows, width),
                  "period_start", "period_end")


def component_metrics(metrics: DataFrame, width: str = "1 minute", delay: str = "10 minutes", p: float = 0.7) -> DataFrame:
    """``logs.component_metrics`` of a stream of samples."""
    return _local(lg.component_metrics(timed(metrics, "timestamp", delay), width, p), "datetime_timestamp")


def trips(fixes: DataFrame, gap: str = journeys.TRIP_GAP, delay: str = "1 hour") -> DataFrame:
    """``journeys.trips`` of a stream of cleaned fixes: sessions that merge in the state store."""
    return _local(journeys.session_trips(timed(fixes.select("vin", "dt", "distance"), "dt", delay), gap),
                  "trip_start", "trip_end")


def _local(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def run(result: DataFrame, base: str, max_dropped: int = 0) -> DataFrame:
    """Run a windowed stream over what its source holds now; the closed windows of all runs so far.

    Files and checkpoint live under ``base``; the file sink's log makes every
    window appear once, also after a restart. Rows behind the watermark are
    counted by Spark: more than ``max_dropped`` of them are an error, never a
    silent loss.
    """
    spark, path = result.sparkSession, f"{base}/windows"
    query = (result.writeStream.format("parquet").option("path", path).outputMode("append")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if dropped > max_dropped:
        raise RuntimeError(f"{dropped} rows came behind the watermark; use a longer delay")
    return spark.read.schema(result.schema).parquet(path)
