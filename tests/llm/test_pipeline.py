import corpus_pipeline as cp
from helpers import DOCS, SMOKE, lower, near_components, smoke_rows
from kestrel.llm import packing
from test_packing import library_ids


def test_stages_are_as_named():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "toxicity", "exact_dedup", "near_dedup", "packing"]


def test_every_stage_keeps_whole_rows_and_decides(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    before = {r.doc_id: tuple(r) for r in docs.collect()}
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, SMOKE), "t")
        after = {r.doc_id: tuple(r) for r in docs.collect()}
        assert all(before[d] == row for d, row in after.items()) and docs.count() == len(after)
        kept[name], before = (before, after), after
    rows = {r[0]: r for r in smoke_rows()}
    source, left = kept["exact_dedup"]
    newest = {}
    for d in source:
        newest[lower(rows[d][1])] = max(d, newest.get(lower(rows[d][1]), d))
    assert set(left) == set(newest.values())
    source, left = kept["near_dedup"]
    comp = near_components([(d, rows[d][1]) for d in source], 5, 80)[1]
    assert set(left) == set(comp.values())
    pieces = cp.pack(spark, docs, SMOKE).collect()
    want = sum(len(x) for x in library_ids([r[1] for r in before.values()]))
    assert sum(p.length for p in pieces) == want and max(p.sequence_id for p in pieces) == (want - 1) // packing.WINDOW


def test_run_equals_the_stages(spark):
    assert set(r.doc_id for r in cp.run(spark, SMOKE).select("doc_id").collect()) <= {r[0] for r in smoke_rows()}


def test_edge_cases(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None, 1), (None, "", "en", "s", 0, 2), (5, "Same words", "en", "s", 1, 3),
         (5, "same WORDS", "en", "s", 1, 4), (6, "same words", None, "s", 1, 5)], DOCS + ", kept int")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, odd, SMOKE)
        assert out.columns == odd.columns
        out.collect()
        assert stage(spark, odd.limit(0), SMOKE).count() == 0
    assert sorted(str(r.doc_id) for r in cp.exact(spark, odd, SMOKE).collect()) == ["6", "None"]
    assert cp.pack(spark, odd.limit(0), SMOKE).count() == 0
