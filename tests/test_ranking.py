from pyspark.sql import functions as F

from kestrel.operators.ranking import with_rank


def test_rank_equals_a_plain_row_number(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 613).alias("v")).repartition(7)
    got = {r.k: r["rank"] for r in with_rank(df, [F.col("v").desc(), F.col("k").asc()]).collect()}
    want = sorted(got, key=lambda k: (-(k * 7919 % 613), k))
    assert got == {k: i for i, k in enumerate(want, 1)}


def test_ties_nulls_and_an_empty_frame(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (1,), (0,)], "v int")
    ranked = [(r.v, r.n) for r in with_rank(df, [F.col("v").asc_nulls_last()], "n").orderBy("n").collect()]
    assert ranked == [(0, 1), (1, 2), (1, 3), (1, 4), (None, 5)]
    assert with_rank(df.limit(0), [F.col("v")]).count() == 0
