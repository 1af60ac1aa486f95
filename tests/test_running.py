import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import journeys as jn
from kestrel.operators import running as rn

ROWS = "k string, t timestamp_ntz, n int, v double"


def _rows(n=600, seed=1):
    """One key holds a third of all rows; some NULL keys, values and equal times."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(rng.choice(["hot", "hot", "hot", None, *"abcdef"]),
             start + dt.timedelta(seconds=rng.randrange(0, 200_000, 50)), i,
             rng.choice([None, 0.5, 1.0, 2.0])) for i in range(n)]


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bucket", [600, 7200, 10**7])
def test_running_equals_a_plain_window(spark, bucket):
    df = spark.createDataFrame(_rows(), ROWS).repartition(5)
    w = Window.partitionBy("k").orderBy("t", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.sum(F.lit(1)).over(w).alias("c"),
                     F.last("v", True).over(w).alias("l"))
    got = rn.running(df, ["k"], ["t", "n"], F.floor(F.unix_timestamp("t") / bucket),
                     {"s": F.col("v"), "c": F.lit(1)}, {"l": F.col("v")})
    assert _sorted(got) == _sorted(want)


@pytest.mark.parametrize("bucket", [600, 3600, 10**7])
def test_range_frame_equals_a_plain_window(spark, bucket):
    rows = _rows() + [("hot", None, -1, 1.0)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    us = F.unix_micros(F.col("t").cast("timestamp"))
    w = Window.partitionBy("k").orderBy(us).rangeBetween(-4000 * 1_000_000, Window.currentRow)
    want = df.select("*", *[F.when(F.col("t").isNotNull(), a.over(w)).alias(n)
                            for n, a in (("m", F.avg("v")), ("c", F.count(F.lit(1))))])
    got = rn.range_frame(df, ["k"], "t", 4000, {"m": F.avg("v"), "c": F.count(F.lit(1))}, bucket)
    assert _sorted(got) == _sorted(want)


def test_last_before_equals_looking_at_all_facts(spark):
    rows, facts = _rows(300, 2), [(k, t, f"d{n}") for k, t, n, _ in _rows(60, 3)]
    rows += [("a", None, 999, 1.0), ("zz", dt.datetime(2024, 1, 1), 1000, None)]
    facts += [("a", dt.datetime(2024, 1, 1, 5), "x"), ("a", dt.datetime(2024, 1, 1, 5), "y"), ("a", None, "never")]
    got = rn.last_before(spark.createDataFrame(rows, ROWS), spark.createDataFrame(facts, "k string, since timestamp_ntz, d string"),
                         ["k"], "t", "since", ["d"], bucket_seconds=3600)
    want = []
    for k, t, n, v in rows:
        fits = [(s, d) for fk, s, d in facts if fk == k and k is not None and t is not None and s is not None and s <= t]
        want.append((k, t, n, v, max(fits)[1] if fits else None))
    assert _sorted(got) == sorted(want, key=str)


def test_empty_frames(spark):
    none = spark.createDataFrame([], ROWS)
    assert rn.running(none, ["k"], ["t"], F.lit(1), {"s": F.col("v")}).count() == 0
    assert rn.range_frame(none, ["k"], "t", 10, {"c": F.count(F.lit(1))}).count() == 0


def test_trips_split_at_gaps_longer_than_the_limit(spark):
    at = dt.datetime(2024, 1, 1, 22)
    minutes = [0, 10, 40, 70, 101, 102]  # neighbours 30 minutes apart stay together
    fixes = spark.createDataFrame([("V", at + dt.timedelta(minutes=m), 1, 48.0, 2.0, 0.5) for m in minutes] +
                                  [("W", at, None, 48.0, 2.0, None)],
                                  "vin string, dt timestamp_ntz, speed int, lat double, lng double, distance double")
    want = [("V", at, at + dt.timedelta(minutes=70), 4, 2.0), ("V", at + dt.timedelta(minutes=101),
            at + dt.timedelta(minutes=102), 2, 1.0), ("W", at, at, 1, None)]
    assert _sorted(jn.trips(fixes, 1800, bucket_seconds=3600)) == sorted(want, key=str)
    assert _sorted(jn.session_trips(fixes, "30 minutes")) == sorted(want, key=str)
