import random

import pytest
from helpers import DOCS, ODD, docs, near_components, smoke_rows
from kestrel.llm import components as cc
from kestrel.llm import near_dedup as nd
from pyspark.sql import functions as F


def check(spark, rows, width, percent, **options):
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = {r.doc_id: r for r in nd.near_dedup(df, width, percent, **options).collect()}
    sets, comp = near_components(rows, width, percent)
    assert {d: r.component_id for d, r in got.items()} == comp
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, width, percent):
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    check(spark, rows, width, percent)


def _edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def test_star_of_near_copies_and_chain(spark):
    # copies of one text that are near to the original but often not to each
    # other, a chain of small steps, and texts that share half of their words
    rnd = random.Random(5)
    base = [f"b{rnd.randrange(500)}" for _ in range(200)]
    rows = [(500, " ".join(base))] + [(501 + i, _edited(rnd, base, 4)) for i in range(120)]
    step = [f"c{i}" for i in range(150)]
    for i in range(12):
        rows.append((i, " ".join(step)))
        step[5 + 10 * i] = f"new{i}"
    half = [f"h{i}" for i in range(60)]
    rows += [(900 + i, " ".join(half + [f"x{i}_{j}" for j in range(40)])) for i in range(40)]
    check(spark, rows, 3, 85)
    check(spark, rows, 3, 85, region=4)


def test_pairs_in_large_regions_without_a_deeper_prefix(spark):
    # pairs among texts that share half of their words; by bad luck no pair shares a deeper prefix
    rnd = random.Random(9)
    half = [f"h{i}" for i in range(60)]
    rows = []
    for p in range(120):
        own = [f"o{p}_{j}" for j in range(40)]
        rows.append((2 * p, " ".join(half + own)))
        for at in rnd.sample(range(2, 38), 3):
            own[at] = f"e{p}_{at}"
        rows.append((2 * p + 1, " ".join(half + own)))
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    reps = nd.signatures(df, 3).withColumnRenamed("doc_id", "id")
    for k in ("k5", "k8"):
        reps = reps.withColumn(k, F.transform("k3", lambda x, k=k: F.xxhash64(F.lit(k), "id", x)))
    reps = reps.withColumn("k3", F.transform("k3", lambda x, i: i.cast("long")))
    got = {r.id: r.component for r in nd.near_components(df, reps, 3, 80).collect()}
    assert {d: got.get(d, d) for d, _ in rows} == near_components(rows, 3, 80)[1]


def test_nulls_repeats_clashing_columns_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1), (7, "a b c d e f", 2), (7, "a b c d e f", 3),
                                (3, "A b c d e f", 4)], "doc_id long, text string, component_id int")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in nd.near_dedup(df, 3, 85).collect())
    assert got == [("3", "3", True), ("7", "3", False), ("7", "3", False), ("None", "None", True)]
    assert nd.near_dedup(docs(spark, ["x"]).limit(0)).count() == 0


def test_different_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (5, a), (5, c), (5, c), (7, c + " more"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in nd.near_dedup(df, 3, 85).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 1, False),
                   (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True)]
    left = sorted((r.doc_id, r.text) for r in nd.drop_near(df, 3, 85).collect())
    assert left == [(1, a), (1, b), (5, c), (8, None)]


def test_components_of_a_long_path(spark):
    ids = list(range(200))
    random.Random(2).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, ids[1:])) + [(1000, 1001)], "a long, b long")
    got = {r.id: r.component for r in cc.components(df).collect()}
    assert got == {**{i: 0 for i in range(200)}, 1000: 1000, 1001: 1000}


def test_sketch_limit_leaves_room():
    assert nd.sketch_limit(85) > 128 * 0.075 + 4 * (128 * 0.075 * 0.925) ** 0.5
    assert nd.sketch_limit(80) < 40  # unrelated sets differ in 64 bits
