import duckdb
import numpy as np
from helpers import DOCS, ODD, SMOKE, docs
from kestrel.llm import toxicity as tx

BIG = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.train(documents, labels.filter("doc_id % 3 <> 1"))
    assert model.thresholds == sorted(model.thresholds)
    got = {r.doc_id: r for r in tx.score(documents, model).collect()}
    truth = duckdb.connect().sql(f"SELECT doc_id, toxic FROM '{BIG}/labels.parquet' WHERE doc_id % 3 = 1").fetchall()
    assert np.mean([got[d].toxic for d, t in truth if t]) > 0.85
    assert np.mean([not got[d].toxic for d, t in truth if not t]) > 0.99
    for r in got.values():
        assert r.p_toxic >= r.p_severe and abs(r.expected_severity - r.p_toxic - r.p_severe) < 1e-12


def test_cumulative_link_recovers_order():
    rnd = np.random.default_rng(1)
    n, width = 3000, 5
    x = rnd.poisson(0.5, (n, width)).astype(float)
    eta = x @ np.array([2.0, 1.0, 0.0, -1.0, 0.5])
    y = (eta + rnd.logistic(size=n) > 1.0).astype(int)
    y += (y == 1) & (eta > 3.0)
    rows, cols = np.nonzero(x)
    w, cut = tx.fit_cumulative(rows, cols, x[rows, cols], y, width)
    assert w[0] > w[1] > w[2] > w[3] and cut[0] < cut[1]


def test_edge_cases(spark):
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    df = docs(spark, ODD).unionByName(spark.createDataFrame([(None, None, None, None, None)] * 2, DOCS))
    neutral = tx.train(df, labels.limit(0))
    out = tx.score(df.withColumnRenamed("n_chars", "grade"), neutral)
    assert out.count() == len(ODD) + 2 and out.filter("toxic").count() == 0
    planted = docs(spark, [f"you vile person {i}" if i % 3 == 0 else f"a kind word {i}" for i in range(60)])
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    model = tx.train(planted, marks)
    assert tx.score(planted, model).filter("toxic").count() == 20
    assert tx.score(df.limit(0), model).count() == 0


def test_every_significant_feature_of_both_signs(spark):
    bad = [f"b{i:03d}" for i in range(700)]
    texts = [" ".join(bad[(i + k) % 700] for k in range(4)) for i in range(700)]
    texts += [f"kind w{i % 300}" for i in range(2100)]
    marks = spark.createDataFrame([(i, 1, int(i < 700)) for i in range(2800)],
                                  "doc_id long, quality int, toxic int")
    model = tx.train(docs(spark, texts), marks)
    assert all(model.weights[w.encode()] > 0 for w in bad) and model.weights[b"kind"] < 0
    assert tx.score(docs(spark, texts), model).filter("toxic").count() == 700
    assert tx.MAX_TRAIN == 20_000
