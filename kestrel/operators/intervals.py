"""Points in intervals, by blocks that fit the interval's length.

``dyadic_cover`` covers an interval of time units by aligned blocks of 1, 2,
4 ... units, at most two of each size. The join needs no exact cover, as the
bounds are checked on each pair: an interval takes the blocks of one size, the
largest power of 16 that is no longer than itself, so it has 17 rows at most
whatever its length. A point lies in one block of every size; it is looked up
once per size that occurs (with days, three sizes reach eleven years, where
powers of two would take twelve). Interval and point share at most one block,
so the equi join on (key, size, block) finds every pair once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes 2^0 .. 2^(MOST_LEVELS - 1) units: 2^40 seconds are 34,000 years.
MOST_LEVELS = 41
#: Block sizes of the join are powers of 2^4.
STEP = 4


def dyadic_cover(lo: Column, hi: Column) -> Column:
    """Blocks ``struct(level, block)`` that cover the whole units lo..hi (both included, of any sign).

    At each level the block at the low end is taken when it is the right half
    of its parent, the one at the high end when it is the left half. What
    remains is the range of whole parents.
    """
    def step(acc, level):
        a, b = acc["a"], acc["b"]
        low, high = (a <= b) & (a.bitwiseAND(1) == 1), (a <= b) & (b.bitwiseAND(1) == 0)
        # one block that is both ends is taken once
        high = high & ~(low & (a == b))
        taken = F.filter(F.array(F.when(low, F.struct(level.alias("level"), a.alias("block"))),
                                 F.when(high, F.struct(level.alias("level"), b.alias("block")))),
                         lambda x: x.isNotNull())
        up_a = F.shiftright(F.when(low, a + 1).otherwise(a), 1)
        up_b = F.shiftright(F.when(high, b - 1).otherwise(b), 1)
        # a range that is used up stays used up
        empty = (a > b) | (F.when(low, a + 1).otherwise(a) > F.when(high, b - 1).otherwise(b))
        return F.struct(F.when(empty, F.lit(1)).otherwise(up_a).cast("long").alias("a"),
                        F.when(empty, F.lit(0)).otherwise(up_b).cast("long").alias("b"),
                        F.concat(acc["out"], taken).alias("out"))

    start = F.struct(lo.cast("long").alias("a"), hi.cast("long").alias("b"),
                     F.array().cast("array<struct<level:int,block:bigint>>").alias("out"))
    levels = F.array(*[F.lit(i) for i in range(MOST_LEVELS)])
    return F.aggregate(levels, start, step)["out"]


def block_level(lo: Column, hi: Column) -> Column:
    """Largest level whose blocks of ``2^level`` units, a power of ``2^STEP``, are no longer than lo..hi."""
    bits = F.length(F.bin((hi - lo + 1).cast("long"))) - 1
    return F.when(lo <= hi, (F.floor(bits / STEP) * STEP).cast("int"))


def points_in_intervals(intervals: DataFrame, points: DataFrame, key: str, point_key: str,
                        lo: Column, hi: Column, at: Column, inside: Column) -> DataFrame:
    """Pairs with equal key, the point's unit in lo..hi, and ``inside`` true.

    ``lo``, ``hi`` (of ``intervals``) and ``at`` (of ``points``) are whole
    units; ``inside`` is the exact condition on a pair's columns, which must
    not clash. Rows whose key, bound or unit is NULL, and intervals with
    lo > hi, give no pair; repeated rows give a pair each. ``intervals`` is
    read twice (once for the sizes that occur), so store it if it is costly.
    """
    left = (intervals.withColumns({"_from": lo.cast("long"), "_to": hi.cast("long")})
            .withColumn("_level", block_level(F.col("_from"), F.col("_to"))).filter(F.col("_level").isNotNull())
            .withColumn("_block", F.expr("explode(sequence(shiftright(_from, _level), shiftright(_to, _level)))"))
            .drop("_from", "_to"))
    # only the sizes that occur are looked up
    sizes = (intervals.select(block_level(lo.cast("long"), hi.cast("long")).alias("_level"))
             .agg(F.sort_array(F.collect_set("_level"))).scalar())
    right = (points.withColumn("_unit", at.cast("long")).filter(F.col("_unit").isNotNull())
             .withColumn("_plevel", F.explode(sizes))
             .withColumn("_pblock", F.expr("shiftright(_unit, _plevel)")))
    return (left.join(right, (F.col(key) == F.col(point_key)) & (F.col("_level") == F.col("_plevel"))
                      & (F.col("_block") == F.col("_pblock")) & inside)
            .drop("_level", "_block", "_unit", "_plevel", "_pblock"))
