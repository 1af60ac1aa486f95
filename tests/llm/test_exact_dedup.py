import hashlib
import random
from functools import reduce

from helpers import DOCS, ODD, docs, lower, smoke_rows
from kestrel.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(lower(t), []).append(d)
    return {(d, max(groups[lower(t)]), len(groups[lower(t)]), d == max(groups[lower(t)]),
             hashlib.sha256(lower(t).encode()).hexdigest()) for d, t in rows}


def answer(df, **options):
    return {tuple(r)[:5] for r in ed.exact_dedup(df, **options).collect()}


def test_fingerprints_compose():
    rnd = random.Random(3)
    raw = bytes(rnd.randrange(256) for _ in range(5000))
    whole = ed.fingerprint(raw)
    for size in (1, 7, 512, 4999, 5000, 9000):
        assert ed.fingerprint(raw, size=size) == whole
    parts = [ed.chunk_hash(c) for c in ed.chunks(raw, 100)]
    left = reduce(ed.combine, parts)
    right = parts[-1]
    for p in reversed(parts[:-1]):
        right = ed.combine(p, right)
    assert left == right and left[1] == len(raw)
    swapped = raw[:10] + raw[137:138] + raw[11:137] + raw[10:11] + raw[138:]
    assert raw[10] == raw[137] or ed.fingerprint(swapped) != whole


def test_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD * 2)]
    rows += [(20_000 + i, "Copy of ONE text") for i in range(300)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    assert answer(df) == brute(rows)


def test_collisions_never_merge(spark):
    texts = [f"{a}{b}" for a in "abcdef" for b in "abcdef"] * 2
    rows = list(enumerate(texts))
    df = docs(spark, texts)
    assert answer(df, prime=7, chunk_bytes=1) == brute(rows)


def test_colliding_texts_under_one_id(spark):
    # different texts of one id share every fingerprint; the classes must still come to an end
    rows = [(1, "ab"), (1, "ba"), (1, "ab"), (2, "BA"), (3, "cd"), (3, "dc"), (None, "ab"), (None, "dc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text_sha256, str(r.keep_id), r.group_size, r.kept)
                 for r in ed.exact_dedup(df, prime=1, chunk_bytes=1).collect())
    want, seen = [], set()
    for d, t in rows:
        group = [e for e, u in rows if lower(u) == lower(t)]
        keep = max((e for e in group if e is not None), default=None)
        first = d == keep and (d, lower(t)) not in seen
        seen |= {(d, lower(t))} if first else set()
        want.append((str(d), hashlib.sha256(lower(t).encode()).hexdigest(), str(keep), len(group), first))
    assert got == sorted(want)


def test_null_ids_repeated_rows_extra_columns_empty(spark):
    df = spark.createDataFrame([(None, "t", 1), (5, "T", 2), (5, "t", 3), (None, "u", 4)],
                               "doc_id long, text string, kept int")
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in ed.exact_dedup(df).collect())
    assert [g for g in got if g[0] == "None"] == [("None", "5", 3, False), ("None", "None", 1, True)]
    assert sorted(g[3] for g in got if g[0] == "5") == [False, True]
    assert answer(df.limit(0)) == set()


def test_drop_copies_keeps_one_row(spark):
    df = spark.createDataFrame([(1, "a", "p"), (1, "A", "q"), (1, "b", "r"), (2, "c", "s"), (3, "C", "t")],
                               "doc_id long, text string, kept string")
    out = sorted((r.doc_id, lower(r.text)) for r in ed.drop_copies(df).collect())
    assert out == [(1, "a"), (1, "b"), (3, "c")]
    once = df.filter("kept <> 'q'")
    assert ed.drop_copies(once).columns == df.columns
    assert sorted(r.doc_id for r in ed.drop_copies(once).collect()) == [1, 1, 3]
