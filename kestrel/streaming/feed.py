"""A table delivered piece by piece in time order, as a source of file streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir, materialize


def piece_of(df: DataFrame, at: str, parts: int) -> Column:
    """Number (from 0) of the equal time span that ``at`` lies in; 0 for a NULL time."""
    us = F.unix_micros(F.col(at).cast("timestamp"))
    span = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    return F.coalesce(F.floor((us - lo) * F.lit(parts) / (hi - lo + 1)), F.lit(0))


def deliveries(df: DataFrame, at: str, parts: int, again: Column | None = None, lag: int = 2,
               closing: DataFrame | None = None) -> Iterator[str]:
    """Appends ``df`` to a fresh folder in ``parts`` pieces, oldest first; yields the folder after each.

    Rows for which ``again`` holds are delivered a second time ``lag`` pieces
    later, if there is such a piece. ``closing`` is a last piece of its own. A
    piece is written by as many tasks as it has; run the stream after each one
    and it is a micro-batch.
    """
    spark, columns = df.sparkSession, df.columns
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kestrel-feed-{uuid.uuid4().hex}"
    first = piece_of(df, at, parts)
    pieces = F.array(first) if again is None else F.when(
        again & (first + lag < parts), F.array(first, first + lag)).otherwise(F.array(first))
    dealt = materialize(df.select("*", F.explode(pieces).alias("_piece")), "feed")
    for k in range(parts):
        dealt.filter(F.col("_piece") == k).select(*columns).write.mode("append").parquet(path)
        yield path
    if closing is not None:
        closing.select(*columns).write.mode("append").parquet(path)
        yield path
