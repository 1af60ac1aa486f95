import hashlib
import math
import re
import zlib
from collections import Counter

from helpers import DOCS, ODD, docs, lower, smoke_rows
from kestrel.llm import resampling as rs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(rows, target, lo=1, hi=1, n_buckets=rs.BUCKETS, percent=10, min_words=20, seed=2024):
    """Every document's (n_features, weight, score, rank) straight from the definition."""
    def found(text):
        words = WORD.findall(lower(text))
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % n_buckets
                            for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]
    feats = [found(t) for _, t in rows]
    own = Counter(b for _, f in feats for b in f)
    want = Counter(b for t in target for b in found(t)[1])
    s_all, t_all = sum(own.values()), sum(want.values())
    gain = {b: math.floor(1000 * math.log((want[b] + 1) * (s_all + n_buckets) / ((own[b] + 1) * (t_all + n_buckets))))
            for b in own}
    out = []
    for (doc_id, _), (n_words, f) in zip(rows, feats):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
        h = int(hashlib.sha256(key).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))),
                    None, n_words])
    enough = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(enough[:len(enough) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_the_splitter_gives_words_with_offsets():
    split = rs.word_splitter()
    for text in [t for t in ODD if t] + ["a-b_c;d", "é\x00ß 日本-x", "9:0/a[z{~\x7f"]:
        text = lower(text)
        assert split(text) == [(m.group(), m.span()) for m in WORD.finditer(text)]


def test_equals_the_definition(spark):
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    texts = [r[1] for r in rows[:7]] + [None, ""]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).withColumnRenamed("lang", "rank").repartition(5)
    assert result(rs.resample(df, target(spark, texts))) == plain(rows, texts)
    options = {"percent": 37, "min_words": 5, "seed": 7}
    got = rs.resample(df, target(spark, texts), shortest=1, longest=3, n_buckets=64, **options)
    assert result(got) == plain(rows, texts, 1, 3, 64, **options)


def test_nulls_ties_and_empty_tables(spark):
    long_text = " ".join(["word"] * 30)
    rows = [(None, long_text), (None, None), (4, ""), (5, long_text), (5, long_text), (6, "few words")]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    for texts in (["word word"], []):
        got = rs.resample(df, target(spark, texts), percent=100)
        assert result(got) == plain(rows, texts, percent=100)
    assert sorted(r.rank for r in got.collect() if r.rank) == [1, 2, 3]
    assert rs.resample(docs(spark, []), target(spark, ["a"])).count() == 0


def test_draws_follow_the_target(spark):
    """Documents like the target are drawn far more often than others."""
    like, other = "alpha beta gamma delta", "one two three four"
    texts = [" ".join([like if i % 10 == 0 else other] * 6) for i in range(1000)]
    got = rs.resample(docs(spark, texts), target(spark, [like] * 5)).collect()
    drawn = [r.doc_id for r in got if r.rank is not None]
    assert len(drawn) == 100 and sum(d % 10 == 0 for d in drawn) > 25
