"""Global row numbers without one task that sees all rows.

``row_number`` over an unpartitioned window sorts the whole table in one task.
Here rows are range-partitioned in the wanted order and sorted inside their
partitions; a row's number is the number of rows in the partitions before its
own (prefix sums over one count per partition) plus its place there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.joins import broadcast_if_bounded
from kestrel.session import materialize

# ``monotonically_increasing_id`` holds the partition above these bits, the row below.
_ROW_BITS = 33


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name`` (long): 1, 2, 3 ... along ``order``.

    ``order`` should be a total order; rows that tie in all of it are numbered
    in any order, each number once. NULLs stand where the sort expressions put
    them. Every row crosses the network once; an empty frame stays empty.
    """
    order = list(order)
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "rank")
    part, row = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(2**_ROW_BITS - 1)
    totals = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (placed.withColumn("_part", part).join(broadcast_if_bounded(bases), "_part")
            .withColumn(name, F.col("_base") + row + 1).drop("_at", "_part", "_base"))
