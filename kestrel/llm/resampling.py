"""Importance resampling towards a target distribution, by hashed word counts.

The target is a table of texts. Words come from a pre-tokenizer that needs no
training: a ``Split`` by a pattern over the text with A-Z lower-cased, which
gives each word with its offsets. Windows of 1 to n consecutive offset pairs
are the features; CRC-32 of a feature (its words joined by one space) modulo
the number of buckets is its bucket. Counts of the buckets in both tables give
each bucket a gain, the scaled log ratio of the target's smoothed share to the
table's own. A document's weight is the floored mean gain over its features,
its score adds Gumbel noise from a hash of the seed and its id, and the
highest scores are drawn: sampling without replacement, in proportion to the
importance weights.

Texts are read once: the buckets of a document's features are stored, so the
counts and the sums of gains read numbers only. What is sent to the driver and
to the tasks is one number per bucket. Ranks come from a range partitioning of
the small rows (``operators.ranking``).

Defined results: a NULL or empty text and a text without a word have no
features and weight 0; a NULL ``doc_id`` is hashed as empty text and loses ties
to every id; repeated rows are counted and drawn as often as they occur, with
ranks of their own; an empty target or an empty table gives gains by the
same formula. A very long text is split in one piece, so memory follows the
longest text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_and_raw, only
from kestrel.operators.ranking import with_rank
from kestrel.session import materialize

#: A word of the pre-tokenizer (ASCII letters and digits, and everything beyond ASCII).
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SCALE = 1000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

_FEATURES = "doc_id long, n_words long, n_features long, buckets binary"
_SCORES = "doc_id long, n_words long, n_features long, weight long, score long"


def word_splitter():
    """``text -> [(word, (start, end)), ...]``; nothing in it is trained."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD_PATTERN), behavior="removed", invert=True).pre_tokenize_str


def feature_buckets(split: list[tuple[str, tuple[int, int]]], shortest: int, longest: int,
                    n_buckets: int) -> list[int]:
    """The bucket of every run of ``shortest`` to ``longest`` consecutive words."""
    words = [w.encode() for w, _ in split]
    out = []
    for n in range(shortest, longest + 1):
        runs = words if n == 1 else (b" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
        out += [crc32(run) % n_buckets for run in runs]
    return out


def features(docs: DataFrame, shortest: int = 1, longest: int = 1, n_buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, buckets (little-endian unsigned 32 bit)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        split = word_splitter()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                few = b.slice(lo, 256)
                n_words, n_features, found = [], [], []
                for cell in few.column("raw"):
                    words = split(cell.as_py().lower().decode())
                    buckets = feature_buckets(words, shortest, longest, n_buckets)
                    n_words.append(len(words))
                    n_features.append(len(buckets))
                    found.append(np.array(buckets, "<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(n_words, pa.int64()),
                     pa.array(n_features, pa.int64()), pa.array(found, pa.binary())],
                    names=["doc_id", "n_words", "n_features", "buckets"])

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, _FEATURES)


def bucket_counts(found: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows of ``features``: one number per bucket."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for cell in b.column("buckets"):
                total += np.bincount(np.frombuffer(cell.as_py(), "<u4"), minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    total = np.zeros(n_buckets, np.int64)
    for bucket, n in counts.collect():  # at most n_buckets rows
        total[bucket] = n
    return total


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's smoothed share over the table's own), per bucket."""
    b, s_all, t_all = len(own), int(own.sum()), int(target.sum())
    return np.array([math.floor(SCALE * math.log(
        float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))))
        for s, t in zip(own.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Scaled Gumbel noise that depends on the seed and the id only."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """Rows of ``features`` with weight and score."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            weights = []
            for cell in b.column("buckets"):
                at = np.frombuffer(cell.as_py(), "<u4")
                weights.append(int(gains[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), b.column("n_features"),
                 pa.array(weights, pa.int64()),
                 pa.array([w + gumbel(i, seed) for i, w in zip(ids, weights)], pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    return found.mapInArrow(run, _SCORES)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED, shortest: int = 1, longest: int = 1, n_buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL: not drawn)."""
    found = materialize(features(docs, shortest, longest, n_buckets, id_col, text_col), "resample-features")
    wanted = features(target.withColumn("_no_id", F.lit(None).cast("long")), shortest, longest, n_buckets,
                      "_no_id", target_text_col)
    gains = bucket_gains(bucket_counts(found, n_buckets), bucket_counts(wanted, n_buckets))
    scored = materialize(scores(found, gains, seed), "resample-scores")
    enough = F.col("n_words") >= min_words
    drawn = scored.filter(enough).count() * percent // 100
    ranked = with_rank(scored.filter(enough), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return (ranked.withColumn("rank", rank)
            .unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))))
