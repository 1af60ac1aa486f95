import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from helpers import ODD, DOCS, docs, smoke_rows
from kestrel.llm import fingerprints as fp

W, N = fp.WINDOW, fp.NEIGHBOURS


def plain_class(window):
    counts = Counter(window)
    total = sum(int(fp._G[c]) for c in counts.values())
    assert abs(total / fp._ONE - sum(c * math.log2(c) for c in counts.values())) < 0.01
    return fp.CLASSES - total * fp.CLASSES // int(fp._G[W])


def plain_hashes(raw, ranks):
    """Features by the definition, one window and one neighbourhood at a time."""
    if not raw:
        return []
    if len(raw) < W:
        rows, salt = [raw.ljust(W, b"\0")], len(raw)
    else:
        of = [int(ranks[plain_class(raw[i:i + W])]) for i in range(len(raw) - W + 1)]
        votes = [0] * len(of)
        for lo in range(1 - N, len(of)):
            near = range(max(lo, 0), min(lo + N, len(of)))
            votes[min(near, key=lambda i: (of[i], i))] += 1
        at = [i for i, v in enumerate(votes) if v >= fp.VOTES and of[i] != fp._LAST] or [votes.index(max(votes))]
        rows, salt = [raw[i:i + W] for i in at], W
    out = []
    for row in rows:
        h = salt
        for i in range(0, W, 8):
            h = (h + int.from_bytes(row[i:i + 8], "little")) * 0x9E3779B97F4A7C15 % 2**64
            h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % 2**64
            h ^= h >> 32
        out.append(h)
    return list(dict.fromkeys(out))


def plain_print(raw, ranks):
    hashes = plain_hashes(raw, ranks)
    chain = []
    for lo in range(0, len(hashes), fp.PER_FILTER):
        bits = bytearray(fp.FILTER_BITS // 8)
        for h in hashes[lo:lo + fp.PER_FILTER]:
            for i in range(fp.FEATURE_BITS):
                b = (h >> 12 * i) % fp.FILTER_BITS
                bits[b // 8] |= 128 >> b % 8
        chain.append(bytes(bits))
    return f"{len(hashes)}:{base64.b64encode(b''.join(chain)).decode()}" if hashes else ""


def plain_ranks(raws):
    counts = Counter(plain_class(r[i:i + W]) for r in raws for i in range(len(r) - W + 1))
    order = sorted(range(fp.CLASSES + 1), key=lambda c: (counts[c], c))
    return np.array([fp._LAST if c <= fp.LOW_CLASS else order.index(c) for c in range(fp.CLASSES + 1)], np.int16)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (n_a, x), (n_b, y) = fp.from_text(a), fp.from_text(b)
    m = fp.FILTER_BITS

    def held(n, p, q):
        total = 0.0
        for k, f in enumerate(p):
            share = 0.0
            for g in q:
                chance = f.sum() * g.sum() / m
                spread = math.sqrt(chance * (1 - f.sum() / m) * (1 - g.sum() / m))
                both = int((f & g).sum())
                if both > chance + fp.SIGMAS * spread:
                    share += (both - chance) / (f.sum() - chance)
            total += min(share, 1.0) * min(fp.PER_FILTER, n - k * fp.PER_FILTER)
        return total / n

    return min(held(n_a, x, y), held(n_b, y, x))


TEXTS = [t for _, t, *_ in smoke_rows()][:60] + ODD


def test_ranks_and_prints_equal_the_definition():
    raws = [(t or "").encode()[:3000] for t in TEXTS]
    ranks = fp.ranks_of(fp.class_counts(raws))
    assert (ranks == plain_ranks(raws)).all()
    for raw, got in zip(raws, fp.digests(raws, ranks)):
        assert fp.as_text(got) == plain_print(raw, ranks)
        n, chain = fp.from_text(fp.as_text(got))
        assert n == got[0] and (chain == got[1]).all()


def test_prints_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    raws = [(t or "").encode() for t in TEXTS]
    ranks = fp.ranks_of(fp.class_counts(raws))
    want = [fp.as_text(p) for p in fp.digests(raws, ranks)]
    assert [fp.as_text(fp.digests([r], ranks)[0]) for r in raws] == want
    monkeypatch.setattr(fp, "BLOCK", 100)
    assert (fp.ranks_of(fp.class_counts(raws)) == ranks).all()
    assert [fp.as_text(p) for p in fp.digests(raws, ranks)] == want


def test_likeness_follows_the_shared_share():
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(4000)]
    whole = " ".join(rng.choice(words, 3000)).encode()
    other = " ".join(rng.choice(words, 3000)).encode()
    ranks = fp.ranks_of(fp.class_counts([whole, other]))
    for share in (0.1, 0.3, 0.5, 0.8, 0.95):
        cut = int(len(whole) * share)
        a, b, c = fp.digests([whole, whole[:cut] + other[cut:], b"ab" + whole], ranks)
        assert abs(fp.likeness(a, b) - share) < 0.08
        assert fp.likeness(a, b) == fp.likeness(b, a)
        assert fp.likeness(a, c) > 0.95
    assert fp.likeness(a, fp.digests([other], ranks)[0]) == 0.0


@pytest.mark.parametrize("parts", [1, 4])
def test_query_equals_the_definition(spark, parts):
    rows = [(1000 + 7 * i, t) for i, t in enumerate(TEXTS)]
    df = docs(spark, [t for _, t in rows]).repartition(parts).withColumnRenamed("n_chars", "Raw")
    ranks = fp.rarity_ranks(df)
    assert (ranks == plain_ranks([(t or "").encode() for t in TEXTS])).all()
    got = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    assert sorted(got) == list(range(len(TEXTS)))
    texts = [t or "" for t in TEXTS]
    prints = [fp.as_text(p) for p in fp.digests([t.encode() for t in texts], ranks)]
    for i, t in enumerate(texts):
        following, k = texts[(i + 1) % len(texts)], len(t) // 2
        new = t[:len(t) - k] + following[:k]
        new_print = fp.as_text(fp.digests([new.encode()], ranks)[0])
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (prints[i], new_print)
        assert abs(got[i].near_edited - plain_likeness(prints[i], new_print)) < 1e-5
        assert abs(got[i].near_next - plain_likeness(prints[i], prints[(i + 1) % len(texts)])) < 1e-5


def test_nulls_repeated_rows_and_empty_tables(spark):
    same = "the same text in many rows, long enough for a few windows of the print"
    rows = [(None, same, "en", "s", 1)] * 50 + [(None, None, "en", "s", 0), (3, "", None, None, None), (3, "", "en", "s", 1),
            (3, "short", "en", "s", 1)]
    got = fp.fingerprints(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert len(got) == len(rows)
    assert len({r.fingerprint for r in got if r.n_chars == len(same)}) == 1
    assert sorted(r.near_next for r in got if r.doc_id == 3)[-1] == 1.0  # two empty ones beside each other
    alone = fp.fingerprints(spark.createDataFrame([(9, "abcdef" * 20, "en", "s", 1)], DOCS)).collect()
    assert [(r.near_next, r.edited_sha256) for r in alone] == [
        (1.0, hashlib.sha256(("abcdef" * 20)[:60].encode() * 2).hexdigest())]
    assert fp.fingerprints(spark.createDataFrame([], DOCS)).collect() == []


def test_a_long_text_in_little_time():
    import time
    text = " ".join(f"word{i * i % 99991}" for i in range(400_000)).encode()
    t = time.time()
    ranks = fp.ranks_of(fp.class_counts([text]))
    a, b = fp.digests([text, b"x" * len(text)], ranks)
    assert fp.likeness(a, a) == 1.0 and fp.likeness(a, b) == 0.0 and b[0] == 1
    assert time.time() - t < 20
