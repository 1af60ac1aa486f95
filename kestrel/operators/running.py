"""Running sums, carried values and RANGE frames without one task per key.

A window over ``partitionBy(key)`` puts all rows of a key in one task. Here the
window runs inside (key, bucket); what a bucket hands on, one row of totals,
is summed along the key's buckets and added back. Results equal the plain
window's. Buckets must not decrease along the order, e.g. the hour of the
first order column; how full a bucket gets is bounded by the source's rate,
not by the length of the key's history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
            sums: Mapping[str, Column] | None = None,
            lasts: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with running sums and last non-NULL values up to and including each row.

    ``sums`` and ``lasts`` map new column names to expressions over ``df``.
    ``order`` should be a total order inside a key. NULLs add nothing to a sum
    (a sum of nothing is 0) and are skipped by ``lasts`` (NULL while there is
    none). NULL keys are a key of their own; a NULL bucket comes first. Pass 1
    writes each bucket's own window; pass 2 reads one row per bucket (its last)
    and joins the totals of the buckets before it to the stored rows.
    """
    keys, sums, lasts = list(keys), dict(sums or {}), dict(lasts or {})
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = materialize(df.withColumn("_bk", bucket).select(
        "*", *[F.coalesce(F.sum(e).over(upto), F.lit(0)).alias(n) for n, e in sums.items()],
        *[F.last(e, ignorenulls=True).over(upto).alias(n) for n, e in lasts.items()],
        F.lead(F.lit(1)).over(w).isNull().alias("_end")), "running")
    before = (Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy(F.col("_b").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    handed = (own.filter("_end")
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bk").alias("_b"), *sums, *lasts)
              .select(*[f"_k{i}" for i in range(len(keys))], "_b",
                      *[F.sum(n).over(before).alias(f"_before_{n}") for n in sums],
                      *[F.last(n, ignorenulls=True).over(before).alias(f"_before_{n}") for n in lasts]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)],
                  F.col("_bk").eqNullSafe(F.col("_b")))
    return own.join(handed, same).select(
        *df.columns, *[(F.col(n) + F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(n, f"_before_{n}").alias(n) for n in lasts])


def last_before(events: DataFrame, facts: DataFrame, keys: Sequence[str], at: str, fact_at: str,
                values: Sequence[str], bucket_seconds: int = 86400) -> DataFrame:
    """As-of join: ``events`` with ``values`` of the latest fact of their key at or before ``at``.

    Both sides share the names in ``keys``; ``at`` and ``fact_at`` are
    timestamps. Facts and events become one sequence per key, facts first at
    equal times, along which the values are carried (``running``). No pair is
    ever built, and a key with a third of all rows is spread over its buckets.
    Events with a NULL key or time, and those before the first fact, get NULLs.
    Of several facts at one time the greatest values count.
    """
    keys, values, cols = list(keys), list(values), events.columns
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    lines = (facts.filter(known & F.col(fact_at).isNotNull())
             .groupBy(*keys, fact_at).agg(F.max(F.struct(*values)).alias("_fact"))
             .select(*keys, F.col(fact_at).alias("_at"), F.lit(0).alias("_kind"), "_fact"))
    rows = events.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                         F.struct(*[F.col(c) for c in cols]).alias("_event"))
    fits = known & F.col("_at").isNotNull()
    both = rows.filter(fits).unionByName(lines, allowMissingColumns=True)
    carried = running(both, keys, ["_at", "_kind"], F.floor(F.unix_timestamp("_at") / bucket_seconds),
                      lasts={"_found": F.col("_fact")}).filter("_kind = 1")
    out = carried.select("_event.*", *[F.col(f"_found.{v}").alias(v) for v in values])
    rest = rows.filter(~fits).select("_event.*")
    return out.unionByName(rest, allowMissingColumns=True)


def range_frame(df: DataFrame, keys: Sequence[str], at: str, width_seconds: int,
                aggregates: Mapping[str, Column], bucket_seconds: int = 3600) -> DataFrame:
    """``df`` with aggregates over the rows of its key from ``width_seconds`` before ``at`` to ``at``.

    Equals ``RANGE BETWEEN width PRECEDING AND CURRENT ROW`` (rows of the same
    time included). Each row also stands, as a halo, in the following buckets
    that its width reaches into (one, as long as the width is at most a
    bucket); halo rows feed the frames there and are dropped. One shuffle; a
    key is spread over its buckets. Rows with a NULL time get NULLs.
    """
    keys, cols = list(keys), df.columns
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    first = F.floor(micros / (bucket_seconds * 1_000_000))
    last = F.floor((micros + width_seconds * 1_000_000) / (bucket_seconds * 1_000_000))
    x = (df.filter(F.col(at).isNotNull())
         .select("*", micros.alias("_us"), first.alias("_home"), F.explode(F.sequence(first, last)).alias("_bk")))
    w = Window.partitionBy(*keys, "_bk").orderBy("_us").rangeBetween(-width_seconds * 1_000_000, Window.currentRow)
    out = (x.select("*", *[a.over(w).alias(n) for n, a in aggregates.items()])
           .filter("_home = _bk").select(*cols, *aggregates))
    return out.unionByName(df.filter(F.col(at).isNull()), allowMissingColumns=True)
