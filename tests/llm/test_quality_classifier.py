import duckdb
import numpy as np
from helpers import DOCS, ODD, SMOKE, docs
from kestrel.llm import quality_classifier as qc

BIG = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    out = qc.score(documents, labels.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r.quality_kept for r in out.select("doc_id", "quality_kept").collect()}
    truth = duckdb.connect().sql(f"SELECT doc_id, quality FROM '{BIG}/labels.parquet' WHERE doc_id % 2 = 1").fetchall()
    assert np.mean([got[d] == bool(q) for d, q in truth]) > 0.93
    assert np.mean([got[d] for d, q in truth if q]) > 0.97


def test_sparse_sites_shrink_to_their_host(spark):
    rows = [("h1", "a", .9)] * 400 + [("h1", "b", .1)] + [("h2", "a", .2)] * 400 + [("h3", "z", .9)]
    rows = [(h, p, x + 0.05 * (i % 2)) for i, (h, p, x) in enumerate(rows)]
    sites = {(r._host, r._path): r for r in qc.site_priors(
        spark.createDataFrame(rows, "source string, lang string, _p double"), "source", "lang").collect()}
    mean = lambda r: (r.s + r.m * r.host_prob) / (r.n + r.m)
    assert abs(sites["h1", "a"].host_prob - .92) < .03 and abs(sites["h2", "a"].host_prob - .225) < .05
    lone = sites["h3", "z"]
    assert lone.mu - .05 < lone.host_prob < .9  # one document: between the global mean and its own
    assert .1 < mean(sites["h1", "b"]) < .93


def test_fit_logistic_separates():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(500, 2))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    mean, scale, w, b = qc.fit_logistic(x, y)
    assert ((((x - mean) / scale) @ w + b > 0) == (y > 0)).mean() > .97


def test_edge_cases(spark):
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    df = docs(spark, ODD).unionByName(spark.createDataFrame([(None, None, None, None, None)] * 2, DOCS))
    out = qc.score(df.withColumnRenamed("n_chars", "path_prob"), labels.limit(0))
    assert out.count() == len(ODD) + 2 and out.filter("NOT quality_kept").count() == 0
    assert qc.score(df.limit(0), labels).count() == 0
    assert qc.score(df, labels).filter("quality_prob IS NULL").count() == 0


def test_long_texts_without_spaces_end(spark):
    """Words that repeat are whole words beside each other; a run without spaces is read once."""
    import time
    texts = ["x" * 5_000_000, "the the cat cat at a a", " ".join(["same"] * 100_000)]
    t = time.time()
    rows = qc.with_features(docs(spark, texts)).select("doc_id", "_x").collect()
    doubled = {r.doc_id: r["_x"][qc.FEATURES.index("doubled")] for r in rows}
    assert time.time() - t < 60
    assert doubled[0] == 0 and doubled[1] == 2 / 7 and doubled[2] == 0.5
