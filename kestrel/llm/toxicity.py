"""Toxicity by cumulative-link ordinal regression on sparse word features.

``P(grade >= k) = sigmoid(w . x - threshold_k)`` with one weight vector for all
ordered thresholds. ``x`` holds ``log(1 + count)`` of the words and word
beginnings (four and five bytes, for inflected forms) that speak for or against
toxicity: all that occur in ``LEAST_DOCUMENTS`` labelled documents and differ
between toxic and clean ones by a chi-square beyond ``LEAST_CHI``. The bounded
sample bounds their number.

Grades: 0 not toxic, 1 toxic, 2 severe. Labels say toxic or not; a toxic
document is severe when it has at least as many clearly toxic features as the
median toxic document. The fit uses a bounded sample of labelled
documents (``max_train``, by a hash of the id). Words are runs of letters and
digits with A-Z lower-cased; ASCII punctuation separates them.

Defined results: NULL and empty texts have no features and get the grade the
thresholds give them; repeated rows are scored alike; other columns are
ignored; an empty table gives an empty result; without labels of both kinds
every document has severity 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import Memo, only, raw_text
from kestrel.session import materialize

MAX_TRAIN = 20_000
LEAST_DOCUMENTS = 3
#: The 0.1 % point of chi-square with one degree of freedom.
LEAST_CHI = 10.83
GRADES = 3
REJECT_AT = 0.5
#: Distinct features a task counts before it hands them on.
FLUSH_FEATURES = 300_000
#: Cells of the sparse matrix that a step of the fit takes at once.
BLOCK = 1 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b
               for b in range(256))


def text_words(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


def features(word: bytes) -> tuple[bytes, ...]:
    """A word and its beginnings; the star, which no word holds, marks a beginning."""
    return (word, word[:4] + b"*", word[:5] + b"*") if len(word) > 5 else (word,)


def bag(raw: bytes) -> dict[bytes, int]:
    """How often each feature occurs in one text."""
    found: dict[bytes, int] = {}
    for w, n in Counter(text_words(raw)).items():
        for f in features(w):
            found[f] = found.get(f, 0) + n
    return found


@dataclass
class OrdinalModel:
    weights: dict[bytes, float]
    thresholds: list[float]

    def __post_init__(self) -> None:
        self.memo = Memo(lambda w: tuple(f for f in features(w) if f in self.weights), 200_000)

    def __reduce__(self):
        return OrdinalModel, (self.weights, self.thresholds)

    def eta(self, raw: bytes) -> float:
        """The linear predictor of one text."""
        found: dict[bytes, int] = {}
        for fs in map(self.memo.__getitem__, text_words(raw)):
            for f in fs:
                found[f] = found.get(f, 0) + 1
        return float(sum(self.weights[f] * np.log1p(c) for f, c in found.items()))


def fit_cumulative(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, width: int,
                   grades: int = GRADES, ridge: float = 1.0, steps: int = 500, rate: float = 0.1,
                   times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by Adam on the cumulative-link likelihood.

    ``rows, cols, vals`` are the sparse features, ``y`` the grades and ``times``
    how many documents each row stands for. Thresholds are a first value plus
    positive steps, so they stay ordered.
    """
    size = len(y)
    times = np.ones(size) if times is None else times
    n = times.sum()
    blocks = [slice(at, at + BLOCK) for at in range(0, len(rows), BLOCK)]
    theta = np.zeros(width + grades - 1)
    theta[width] = 2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sig = lambda a: 1 / (1 + np.exp(-np.clip(a, -30, 30)))

    def thresholds(raw: np.ndarray) -> np.ndarray:
        return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])

    for step in range(1, steps + 1):
        cut = thresholds(theta[width:])
        eta = np.zeros(size)
        for b in blocks:
            eta += np.bincount(rows[b], vals[b] * theta[cols[b]], size)
        above = sig(eta[:, None] - cut[None, :])  # P(y >= k), k = 1..grades-1
        full = np.hstack([np.ones((size, 1)), above, np.zeros((size, 1))])
        p = np.maximum(full[np.arange(size), y] - full[np.arange(size), y + 1], 1e-9)
        slope = np.hstack([np.zeros((size, 1)), above * (1 - above), np.zeros((size, 1))])
        hi, lo = times * slope[np.arange(size), y], times * slope[np.arange(size), y + 1]
        g_eta = -(hi - lo) / p / n
        grad = np.zeros_like(theta)
        for b in blocks:
            grad[:width] += np.bincount(cols[b], vals[b] * g_eta[rows[b]], width)
        grad[:width] += ridge * theta[:width] / n
        g_cut = np.zeros(grades - 1)
        for k in range(1, grades):
            g_cut[k - 1] = (hi * (y == k) / p).sum() / n - (lo * (y + 1 == k) / p).sum() / n
        grad[width] = g_cut.sum()
        for j in range(1, grades - 1):
            grad[width + j] = g_cut[j:].sum() * np.exp(theta[width + j])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:width], thresholds(theta[width:])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id",
          text_col: str = "text") -> OrdinalModel:
    known = labels.select(F.col("doc_id").alias("_lid"), F.col("toxic").cast("int").alias("toxic"))
    sample = (known.filter("_lid IS NOT NULL AND toxic IS NOT NULL")
              .orderBy(F.xxhash64("_lid"), "_lid").limit(max_train))
    texts = materialize(docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("_lid"))
                        .select("toxic", raw_text(text_col).alias("raw")), "tox-texts")

    def counts(batches):
        """(word, toxic documents, documents) of a task; the empty word counts documents with words."""
        found: dict[bytes, list[int]] = {}

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array([x[0] for x in found.values()], pa.int64()),
                 pa.array([x[1] for x in found.values()], pa.int64())], names=["word", "a", "df"])

        for b in batches:
            for y, raw in zip(b.column("toxic").to_pylist(), b.column("raw").to_pylist()):
                words = bag(raw)
                for w in (b"", *words) if words else ():
                    x = found.setdefault(w, [0, 0])
                    x[0] += y
                    x[1] += 1
                if len(found) > FLUSH_FEATURES:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    df = materialize(texts.mapInArrow(counts, "word binary, a long, df long")
                     .groupBy("word").agg(F.sum("a").alias("a"), F.sum("df").alias("df")), "tox-words")
    total = df.filter(F.length("word") == 0).first()
    tox, clean = (total["a"], total["df"] - total["a"]) if total else (0, 0)
    if not tox or not clean:
        return OrdinalModel({}, [30.0, 31.0])
    a, b = F.col("a").cast("double"), (F.col("df") - F.col("a")).cast("double")
    c, d = tox - a, clean - b
    chi = (a * d - b * c) ** 2 * (tox + clean) / ((a + b) * (c + d + 1e-9) * float(tox) * float(clean))
    odds = F.log((a + 0.5) / (tox + 1)) - F.log((b + 0.5) / (clean + 1))
    words = (df.filter((F.length("word") > 0) & (F.col("df") >= LEAST_DOCUMENTS) & (chi > LEAST_CHI))
             .select("word", odds.alias("odds")).orderBy("word").collect())  # bounded by max_train texts
    index = {bytes(r["word"]): i for i, r in enumerate(words)}
    if not index:
        return OrdinalModel({}, [30.0, 31.0])
    strong = np.array([r["odds"] > 2.0 for r in words], float)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def cells(batches):
        """(toxic, cells): the numbers and counts of each text's features, by number."""
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part, kept, out = b.slice(lo, 256), [], []
                for y, raw in zip(part.column("toxic").to_pylist(), part.column("raw").to_pylist()):
                    words = bag(raw)
                    if words:
                        got = sorted((shared.value[w], n) for w, n in words.items() if w in shared.value)
                        kept.append(y)
                        out.append(np.array(got, "<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(out, pa.binary())],
                                                 names=["toxic", "cells"])

    # documents with equal features are one row that counts so many times
    table = (texts.mapInArrow(cells, "toxic int, cells binary")
             .groupBy("toxic", "cells").agg(F.count("*").alias("times")).toArrow())
    held = [np.frombuffer(x, "<u4").reshape(-1, 2) for x in table.column("cells").to_pylist()]
    toxic = table.column("toxic").to_numpy().astype(np.int64)
    times = table.column("times").to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])
    flat = np.concatenate(held)
    cols, n = flat[:, 0].astype(np.int32), flat[:, 1].astype(np.float32)
    hits = np.bincount(rows, strong[cols] * n, len(held))
    grade = toxic.copy()
    some = (toxic == 1) & np.array([len(x) > 0 for x in held])
    if some.any():
        grade[some & (hits >= np.median(np.repeat(hits[some], times[some])))] = 2
    w, cut = fit_cumulative(rows, cols, np.log1p(n), grade, len(index), times=times.astype(float))
    return OrdinalModel({word: float(w[i]) for word, i in index.items()}, [float(x) for x in cut])


def eta_column(model: OrdinalModel, text_col: str = "text") -> Column:
    @F.arrow_udf("double")
    def eta(raw: pa.Array) -> pa.Array:
        only(model.memo)
        return pa.array([model.eta(r) for r in raw.to_pylist()], pa.float64())

    return eta(raw_text(text_col))


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with p_toxic, p_severe, expected_severity, grade and toxic."""
    rows = docs.drop("p_toxic", "p_severe", "expected_severity", "grade", "toxic")
    rows = rows.withColumn("_eta", eta_column(model, text_col))
    above = [1 / (1 + F.exp(F.lit(t) - F.col("_eta"))) for t in model.thresholds]
    p1, p2 = F.col("p_toxic"), F.col("p_severe")
    return (rows.withColumns({"p_toxic": above[0], "p_severe": above[1]}).drop("_eta")
            .withColumns({"expected_severity": p1 + p2,
                          "grade": (p1 >= REJECT_AT).cast("int") + (p2 >= REJECT_AT).cast("int"),
                          "toxic": p1 >= REJECT_AT}))
