from collections import Counter

from helpers import DOCS, ODD, WORD, docs, smoke_rows
from kestrel.llm import quality_rules as qr
from pyspark.sql import functions as F


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [line for line in t.split("\n") if WORD.search(line)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    again = {j for i, g in enumerate(grams) if g in often for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))


def test_measures_equal_brute_force(spark):
    texts = [r[1] for r in smoke_rows()] + ODD + ["a b c a b c a b c", "x\nx\n\n x\nx", "a b a b a", "#|<>&%$* *"]
    got = {r.doc_id: tuple(r)[1:6] for r in qr.measures(docs(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_posterior_separates_planted_junk(spark):
    rows = [r for r in smoke_rows() if len((r[1] or "").split()) >= 60]
    junk = ["### $$$ " + " ".join(f"a{i}%%" for i in range(80)), " ".join(["GO!!", "NOW!!"] * 60),
            "\n".join(["click here now please dear reader"] * 30)]
    df = spark.createDataFrame(rows + [(10_000 + i, t, "en", "s", 0) for i, t in enumerate(junk)], DOCS)
    out = {r.doc_id: r for r in qr.quality(df).collect()}
    assert not any(out[10_000 + i].kept for i in range(3))
    clean = [r[0] for r in rows if not any(c in r[1] for c in "#$%|!")]
    assert sum(out[d].kept for d in clean) >= 0.95 * len(clean)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in out.values())


def test_em_recovers_accuracies(spark):
    # 1000 documents, 20 % bad; rule a finds 90 % of them, b 60 %, c votes at random
    import random
    rnd = random.Random(9)
    counts = Counter()
    for i in range(20_000):
        bad = i % 5 == 0
        v = (-1 if rnd.random() < (.9 if bad else .01) else 0, -1 if rnd.random() < (.6 if bad else .02) else 0,
             1 if rnd.random() < (.05 if bad else .7) else 0)
        counts[v] += 1
    df = spark.createDataFrame([(*v, n) for v, n in counts.items()], "v_a int, v_b int, v_c int, n long")
    model = qr.fit(df.withColumn("codes", qr.vote_codes(["a", "b", "c"])), ["a", "b", "c"], 100)
    assert abs(model.prior - .8) < .03
    assert abs(model.p[0]["a"][-1] - .9) < .06 and abs(model.p[0]["b"][-1] - .6) < .06
    assert model.accuracy("a") > .9


def test_only_spark_functions(spark):
    plan = qr.measures(docs(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edge_cases(spark):
    df = docs(spark, ODD).withColumn("n_words", F.lit("clash"))
    out = {r.doc_id: r for r in qr.quality(df.union(df)).collect()}
    assert len(out) == len(ODD) and out[0].n_words == 0 and out[0].base_failed and not out[0].kept
    assert qr.quality(df.limit(0)).count() == 0
