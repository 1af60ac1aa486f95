"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id on an edge; component is the smallest id reachable.

    Alternating large-star and small-star rounds: every node points its larger
    (then its smaller) neighbours to the smallest one it knows, until nothing
    changes. A round is a ``min`` with partial aggregation and a join that
    Spark can split at a hub; rounds grow with the logarithm of a component's
    size. Each round is written out, so a lost executor repeats one round only.
    """
    pair = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = materialize(edges.select(*pair).filter("u <> v").distinct(), "cc")
    state = _state(now)
    while state[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(both.groupBy("u").agg(F.min("v").alias("v")).filter("v < u"))
                 .filter("u <> v").distinct())
        large = materialize(large, "cc")
        small_m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small_m.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        now = materialize(small, "cc")
        after = _state(now)
        if after == state:
            break
        state = after
    return (now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
            .union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
