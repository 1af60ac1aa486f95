"""Previous / next row per entity, without putting a hot entity in one task.

``lag``/``lead`` over ``Window.partitionBy(entity)`` sends all rows of an
entity to one task: an entity holding a third of the data would make that
task a third of the job. Here the window is partitioned by
(entity, time bucket) -- a bucket's size is bounded by the sampling rate of
the source. The windowed rows are written out once; then only the rows at
bucket edges (the first and the last of each bucket, two at most) are read
again and take their neighbour from the edge row beside them in a window over
the entity. Results equal a plain ``lag``/``lead`` over the entity's whole
ordered history, for one pass over the input and one shuffle of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                    prev: Sequence[str] = (), next: Sequence[str] = (),
                    prev_prefix: str = "prev_", next_prefix: str = "next_") -> DataFrame:
    """Add ``prev_prefix+v`` for v in ``prev`` and ``next_prefix+v`` for v in ``next``.

    ``order`` must be a total order within a key (add tie-breakers); ``bucket``
    must be non-decreasing along ``order`` (e.g. the day of the first order
    column). Rows with a NULL bucket get no neighbour across buckets.
    """
    keys, order, prev, nxt = list(keys), list(order), list(prev), list(next)
    b = df.withColumn("_bk", bucket)
    w = Window.partitionBy(*keys, "_bk").orderBy(*[F.col(c) for c in order])
    x = materialize(b.select("*", *[F.lag(c).over(w).alias(prev_prefix + c) for c in prev],
                             *[F.lead(c).over(w).alias(next_prefix + c) for c in nxt],
                             (F.row_number().over(w) == 1).alias("_first"),
                             F.lead(F.lit(1)).over(w).isNull().alias("_last")), "neighbours")
    inner = x.filter("NOT _first AND NOT _last")
    # edge rows of a key in order: first, last, first, last, ... (one row may be both)
    along = Window.partitionBy(*keys).orderBy("_bk", F.when(F.col("_first"), 0).otherwise(1))
    known = F.col("_bk").isNotNull()
    from_prev = F.col("_first") & known & F.lag("_bk").over(along).isNotNull()
    edges = x.filter("_first OR _last").select(
        *df.columns,
        *[F.when(from_prev, F.lag(c).over(along)).otherwise(F.col(prev_prefix + c))
          .alias(prev_prefix + c) for c in prev],
        *[F.when(F.col("_last") & known, F.lead(c).over(along)).otherwise(F.col(next_prefix + c))
          .alias(next_prefix + c) for c in nxt])
    return inner.select(edges.columns).unionByName(edges)


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: Sequence[str], bucket: Column, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix+v`` = value of ``v`` on the previous row of the same key."""
    return with_neighbours(df, keys, order, bucket, prev=values, prev_prefix=prefix)


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: Sequence[str], bucket: Column, prefix: str = "next_") -> DataFrame:
    """Add ``prefix+v`` = value of ``v`` on the next row of the same key."""
    return with_neighbours(df, keys, order, bucket, next=values, next_prefix=prefix)
