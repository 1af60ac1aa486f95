import math
import zlib
from collections import Counter

import numpy as np
from helpers import DOCS, ODD, smoke_rows
from kestrel.llm import class_lm as lm


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def held_out(d):
    return zlib.crc32(str(d).encode()) % 5 == 1


def test_base_equals_brute_force_and_model_beats_it(spark):
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = {r.doc_id: r for r in lm.score(df, n_classes=16, min_share=1e-3).collect()}
    c = Counter(w for d, t in rows if not held_out(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    sums = np.zeros(2)
    for d, t in rows:
        r, w = got[d], tokens(t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held_out(d), len(w), n)
        assert r.n_known == sum(x in c for x in w)
        base = sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w)
        assert abs(r.base_score - base) < 1e-6 and r.score < 0
        assert abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity
        if r.held_out and d < 10_000:
            sums += (r.score, r.base_score)
    assert sums[0] > sums[1]


def test_scores_equal_a_plain_second_model(spark):
    """Classes as learnt; class counts, emissions and transitions computed anew from the texts, word by word."""
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    k, share = 16, 1e-3
    df = df.coalesce(1)  # several slices of a batch
    fitted = lm.fit(df, k, share)
    assert all(y >= x - 1e-9 * abs(x) for x, y in zip(fitted.steps, fitted.steps[1:]))
    assert fitted.steps[-1] > fitted.steps[0]
    train = Counter(w for d, t in rows if not held_out(d) for w in tokens(t))
    own = {r["hash"]: (r["class"], r["n"]) for r in fitted.words.collect()}
    frequent = {w for w, n in train.items() if w != b" " and n >= max(2, share * sum(train.values()))}
    rare = {w for w in train if w != b" "} - frequent
    # every rarer word is there with its count, and those seen twice have a class
    assert own.keys() == {lm.word_hash(w) for w in rare}
    assert all(own[lm.word_hash(w)][1] == train[w] for w in rare)
    assert all((own[lm.word_hash(w)][0] is None) == (train[w] < 2) for w in rare)
    position = {h: i + 1 for i, h in enumerate(sorted(lm.word_hash(w) for w in frequent))}
    first = 1 + len(position)

    def class_of(w):
        if w == b" ":
            return 0
        h = lm.word_hash(w)
        if h in position:
            return int(fitted.classes[position[h]])
        if train[w] >= 2:
            return own[h][0]
        return int(fitted.classes[first + lm.family(w)])

    # one member for each word with a class of its own, one for each family
    tokens_of, members = [0.0] * k, [0] * k
    for w, n in train.items():
        tokens_of[class_of(w)] += n
        members[class_of(w)] += n >= 2 or w == b" "
    for f in range(lm.FAMILIES):
        members[int(fitted.classes[first + f])] += 1
    singles = Counter(lm.family(w) for w in rare if train[w] == 1)

    def emission(w):
        if w == b" ":
            return 0.0
        c = class_of(w)
        mass = tokens_of[c] + .5 * members[c]
        if train[w] >= 2:
            return math.log10((train[w] + .5) / mass)
        v = singles[lm.family(w)]
        return math.log10((v + .5) / mass) + math.log10((train[w] + .5) / (v + .5 * (v + 1)))

    pairs = Counter()
    for d, t in rows:
        c = [0, *map(class_of, tokens(t))]
        if not held_out(d):
            pairs.update(zip(c, c[1:]))
    out_of = [sum(pairs[i, j] for j in range(k)) for i in range(k)]
    got = {r.doc_id: r.score for r in lm.score(df, k, share).collect()}
    for d, t in rows:
        c = [0, *map(class_of, tokens(t))]
        want = sum(map(emission, tokens(t))) + sum(
            math.log10((pairs[x] + .5) / (out_of[x[0]] + .5 * k)) for x in zip(c, c[1:]))
        assert abs(got[d] - want) < 1e-6 * max(1, abs(want))


def test_classes_stay_when_the_corpus_is_doubled(spark):
    rows = [(r[0], r[1]) for r in smoke_rows() if not held_out(r[0])]
    once = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    a, b = lm.fit(once, 8, 1e-3), lm.fit(once.unionAll(once), 8, 1e-3)
    assert (a.types.hashes == b.types.hashes).all()
    assert (a.classes[:a.types.first_family] == b.classes[:a.types.first_family]).mean() > 0.9
    twice = {r["hash"]: r["class"] for r in b.words.collect()}
    kept = [(r["class"], twice[r["hash"]]) for r in a.words.collect() if r["class"] is not None]
    assert kept and all(y is not None for _, y in kept)
    assert sum(x == y for x, y in kept) > 0.8 * len(kept)


def test_probabilities_sum_to_one():
    n = lm.FAMILIES
    types = lm.Types(np.array([5, 9]), np.array([10, 7, 3, *([2] * n)]), np.full(n, 2), 0, 0)
    cls = lm.first_classes(types, 8)
    assert cls[0] == 0 and (cls[1:] > 0).all()
    mat = np.random.default_rng(0).integers(0, 50, (8, 8)).astype(float)
    assert np.allclose((10 ** lm.transitions(mat)).sum(axis=1), 1)
    # two rarer words with counts 4 and 6 in each class but the end's
    e = lm.emissions(types, cls, np.array([0, *[10] * 7]), np.array([0, *[2] * 7]))
    for k in range(1, 8):
        own = e.rare(np.array([4, 6]), np.array([k, k]), np.array([0, 0]))
        assert abs((10 ** e.of_type[cls == k]).sum() + (10 ** own).sum() - 1) < 1e-9
    # inside a family: seen words and one share for all unseen ones
    inside = 10 ** e.rare(np.array([1, 1, 0]), np.full(3, -1), np.zeros(3, int))
    assert abs(inside.sum() - 10 ** e.of_type[3]) < 1e-12


def test_choice_equals_one_type_at_a_time(monkeypatch):
    rnd = np.random.default_rng(5)
    k, words = 6, 200
    mat = rnd.integers(50, 500, (k, k)).astype(float)
    ctx = rnd.integers(0, 4, (words, 2 * k))
    now = rnd.integers(1, k, words)
    at, cell = np.nonzero(ctx)
    got = lm.best_classes(at, cell, ctx[at, cell].astype(float), now, mat)
    monkeypatch.setattr(lm, "WEIGHED", 7)
    assert (lm.best_classes(at, cell, ctx[at, cell].astype(float), now, mat) == got).all()
    x = lambda v: v * math.log(v) if v > 0 else 0.0
    for w in range(words):
        n, gains = ctx[w, :k].sum(), {}
        for c in range(1, k):
            out = lambda v, m: max(v - m, 0) if c == now[w] else v  # noqa: E731, B023
            g = sum(x(out(mat[i, c], ctx[w, i]) + ctx[w, i]) - x(out(mat[i, c], ctx[w, i])) for i in range(k))
            g += sum(x(out(mat[c, i], ctx[w, k + i]) + ctx[w, k + i]) - x(out(mat[c, i], ctx[w, k + i]))
                     for i in range(k))
            size = out(mat[:, c].sum(), n)
            gains[c] = g - 2 * (x(size + n) - x(size))
        assert gains[got[w]] >= max(gains.values()) - 1e-6


def test_settle_across_batches(spark):
    # a word that goes on over many batches, and one seen once
    k = 4
    mat = np.array([[0, 9, 9, 9], [9, 1, 900, 1], [9, 1, 1, 900], [9, 900, 1, 1]], float)
    around = (1 * k + 1) * k + 3  # stands in class 1, between classes 1 and 3: class 2
    rows = spark.range(5000).selectExpr("7L AS hash", f"{around} AS around").union(
        spark.createDataFrame([(8, around), (-3, around), (-3, around)], "hash long, around int"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {r["hash"]: (r["class"], r["n"]) for r in lm.settle(rows, mat).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got[8] == (None, 1) and got[-3] == (2, 2) and got[7][1] == 5000 and got.keys() == {7, 8, -3}


def _likelihood(stream, cls, k):
    c = cls[stream]
    mat = np.bincount(c[:-1] * k + c[1:], minlength=k * k).reshape(k, k).astype(float)
    return lm._xlogx(mat).sum() - lm._xlogx(mat.sum(0)).sum() - lm._xlogx(mat.sum(1)).sum(), mat


def test_exchange_finds_alternating_classes():
    # words of two kinds that alternate: one exchange after another must not lower the likelihood
    rnd = np.random.default_rng(3)
    n, k = 20, 3
    stream = np.where(np.arange(6000) % 2 == 0, rnd.integers(1, 11, 6000), rnd.integers(11, 21, 6000))
    cls = np.concatenate([[0], 1 + np.arange(n) % 2])
    last, mat = _likelihood(stream, cls, k)
    for _ in range(2):
        for t in range(1, n + 1):
            at = np.flatnonzero(stream == t)
            left = np.bincount(cls[stream[at[at > 0] - 1]], minlength=k)
            right = np.bincount(cls[stream[at[at < len(stream) - 1] + 1]], minlength=k)
            ctx = np.concatenate([left, right]).astype(float)
            cell = np.flatnonzero(ctx)
            cls[t] = lm.best_classes(np.zeros(len(cell), int), cell, ctx[cell], cls[t:t + 1], mat)[0]
            now, mat = _likelihood(stream, cls, k)
            assert now >= last - 30
            last = now
    assert len(set(cls[1:11])) == 1 and len(set(cls[11:])) == 1 and cls[1] != cls[11]


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, None, 1), (2, "a b", 2), (2, "a b", 2)], "doc_id long, text string, score int")
    out = sorted((str(r.doc_id), r.n_tokens, r.held_out) for r in lm.score(df, n_classes=4).collect())
    assert out == [("2", 3, held_out(2)), ("2", 3, held_out(2)), ("None", 1, False)]
    assert lm.score(df.limit(0), n_classes=4).count() == 0
