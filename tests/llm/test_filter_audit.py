import re
from itertools import permutations

import numpy as np

from helpers import DOCS, ODD, SMOKE, docs, smoke_rows
from kestrel.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    """Every order applied to every document, one after the other."""
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    fails, parts = [], set()
    for d, t, _, source, *_ in rows:
        text, words = t or "", WORD.findall(t or "")
        bad = {"A"} if len(words) < 50 else set()
        bad |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        bad |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        bad |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        bad |= {"E"} if d is not None and d > first[text] else set()
        marks = [(q, x) for i, q, x in labels if i == d and d is not None]
        fails.append((source or "", bad, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
        parts.add(source or "")
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for step, f in enumerate(order, 1):
            for p in parts:
                mine = [x for x in fails if x[0] == p]
                came = [x for x in mine if not x[1] & set(order[:step - 1])]
                gone = [x for x in came if f in x[1]]
                out[p, order, step] = [len(came) - len(gone), len(gone),
                                       sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                                       sum(x[2] for x in gone), sum(x[3] for x in gone)]
    for (p, order, step), row in list(out.items()):
        f = order[step - 1]
        row.append(sum(out[p, o, o.index(f) + 1][1] for o in map("".join, permutations("ABCDE"))))
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in df.collect()}


def test_equals_applying_every_order(spark):
    rows = smoke_rows()
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet").select("doc_id", "quality", "toxic")
    df = spark.createDataFrame(rows, DOCS).withColumn("part", fa.F.lit("x")).withColumn("bits", fa.F.lit(1))
    assert result(fa.audit(df.repartition(4), labels)) == plain(rows, [tuple(r) for r in labels.collect()])


def test_nulls_copies_and_repeated_labels(spark):
    rows = [(None, "copy", "en", None, 0), (1, "copy", "en", "", 0), (1, "copy", "en", "b", 0), (2, "copy", None, "b", 0),
            (3, "Copy", "en", "b", 0), (4, None, "en", "b", 0), (5, "", "en", "b", 0), (None, None, "en", "b", 0),
            (6, "WORDS " * 60, "en", "b", 0), (7, "a # b", "en", "b", 0)]
    rows += [(20 + i, t, "en", f"s{i % 2}", 0) for i, t in enumerate(ODD)]
    labels = [(2, 0, 0), (2, 1, None), (5, None, 1), (6, 1, 1), (99, 1, 1), (None, 1, 1)]
    got = result(fa.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)))
    assert got == plain(rows, labels) and len(got) == 4 * 600


def test_one_text_in_a_third_of_all_rows(spark):
    texts = ["hot text"] * 400 + [f"text {i}" for i in range(800)]
    got = result(fa.audit(docs(spark, texts), spark.createDataFrame([], LABELS)))
    assert sum(got[p, "EABCD", 1][1] for p in ("s0", "s1")) == 399


def test_empty_table(spark):
    assert fa.audit(docs(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_contraction_of_a_known_tensor():
    """Two filters: 5 pass both, 3 fail the first, 2 the second, 1 both."""
    picked = fa.selections([(0, 1), (1, 0)])
    tensor = np.array([[[[5, 2], [3, 1]]]])
    assert fa.contract(tensor, picked["kept"]).tolist() == [[[7, 5, 8, 5]]]
    assert fa.contract(tensor, picked["removed"]).tolist() == [[[4, 2, 3, 3]]]
    assert fa.contract(tensor, picked["unique_fails"]).tolist() == [[[3, 2, 2, 3]]]
