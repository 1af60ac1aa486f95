"""Filter interaction audit: what each filter removes, in every order of the filters.

Every document gets one bit per filter (1 = fails). Per part (``source``) the
documents are counted by their bits, which makes a 2 x 2 x 2 x 2 x 2 tensor
for each of three weights: all documents, those labelled good, those labelled
toxic. Whatever a step of an order does is a contraction of that tensor: along
each axis it takes the passing half, the failing half or both. One ``einsum``
over (pass, fail, all) vectors gives all orders and steps at once.

Filters (failure conditions): A under 50 words; B 100 * distinct words <
65 * words (case-sensitive); C 100 * ``[A-Z]`` > 5 * code points; D holds any
of ``#$%&*|``; E its text also stands under a smaller ``doc_id``.

Texts are read once, as UTF-8 bytes, and leave the scan as one small row. E
compares texts by SHA-256: the smallest id of each text that occurs more than
once is joined back to the small rows, an inner aggregate with partial sums
and a join whose hot texts Spark can split. The tensors, 2^5 cells per part,
are all that reaches the contraction.

Defined results: NULL text counts as empty (it fails A; 0 < 0 is false, so not
B or C); NULL ``source`` is the part ``""``; a NULL ``doc_id`` has no smaller
id, is nobody's smaller id and has no label; repeated rows of one id and text
are no copies of each other (the id is not smaller); an id with several labels
is good or toxic if any of them says so. A very long text is handled as a
whole, one at a time. Other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import only, raw_text
from kestrel.session import materialize

LETTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
WEIGHTS = ("n", "good", "toxic")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FLAGS = "doc_id long, part string, bits int, sha binary"
_STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_failures(raw: bytes) -> tuple[bool, bool, bool, bool]:
    """Failures of A, B, C, D for one text."""
    words = raw.split()
    points = len(raw) if raw.isascii() else len(raw.decode())
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
            100 * capitals > CAPITAL_PERCENT * points, len(raw.translate(None, SYMBOLS)) < len(raw))


def bit(letter: str) -> int:
    """The first letter is the first axis of the tensor, so the highest bit."""
    return 1 << (len(LETTERS) - 1 - LETTERS.index(letter))


def text_flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               part_col: str = "source") -> DataFrame:
    """One row per document: doc_id, part, bits (A to D), sha (of the whole text)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       raw_text(text_col).alias("raw"))
    values = [bit(x) for x in "ABCD"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            bits, shas = [], []
            for cell in b.column("raw"):
                raw = cell.as_py()
                bits.append(sum(v for v, fails in zip(values, text_failures(raw)) if fails))
                shas.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(bits, pa.int32()),
                 pa.array(shas, pa.binary())], names=["doc_id", "part", "bits", "sha"])

    return rows.mapInArrow(run, _FLAGS)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """One row per document: doc_id, part, bits (A to E)."""
    flags = materialize(text_flags(docs, id_col, text_col, part_col), "audit-flags")
    firsts = (flags.groupBy("sha").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").select("sha", "_first"))
    copy = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    return (flags.join(firsts, "sha", "left")
            .select("doc_id", "part", (F.col("bits") + F.when(copy, bit("E")).otherwise(0)).alias("bits")))


def cells(fails: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per part and bits: n, good, toxic."""
    marks = (labels.select(F.col(f"`{id_col}`").cast("long").alias("_id"), "quality", "toxic")
             .groupBy("_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"),
                                 F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")))
    return (fails.join(marks, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "bits")
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("_toxic"), F.lit(0)).alias("toxic")))


def selections(orders: list[tuple[int, ...]]) -> dict[str, np.ndarray]:
    """For each measure: (orders * steps, axes, 2) vectors that pick pass, fail or all of each axis."""
    axes = len(orders[0])
    take = {"pass": (1, 0), "fail": (0, 1), "all": (1, 1)}
    out: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order in orders:
        for step, axis in enumerate(order):
            earlier = set(order[:step])
            for name, own, before, others in (("kept", "pass", "pass", "all"), ("removed", "fail", "pass", "all"),
                                              ("failing", "fail", "all", "all"),
                                              ("unique_fails", "fail", "pass", "pass")):
                out[name].append([take[own if a == axis else before if a in earlier else others]
                                  for a in range(axes)])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def contract(tensor: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """(parts, weights, 2, 2, ...) with (steps, axes, 2): (parts, weights, steps)."""
    axes = "abcdefghijklm"[:picked.shape[1]]
    vectors = ",".join(f"z{a}" for a in axes)
    return np.einsum(f"pw{axes},{vectors}->pwz", tensor, *(picked[:, i] for i in range(len(axes))),
                     optimize="greedy")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counted = cells(failures(docs, id_col, text_col, part_col), labels, id_col)
    # at most 2^5 cells a part
    tensors = counted.groupBy("part").agg(F.collect_list(F.struct("bits", *WEIGHTS)).alias("cells"))
    k = len(LETTERS)
    orders = list(permutations(range(k)))
    names = ["".join(LETTERS[a] for a in o) for o in orders for _ in range(k)]
    steps = list(range(1, k + 1)) * len(orders)
    filters = np.array([a for o in orders for a in o])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        picked = selections(orders)
        for b in batches:
            for lo in range(0, b.num_rows, 32):
                few = b.slice(lo, 32)
                tensor = np.zeros((few.num_rows, len(WEIGHTS), 2**k), np.int64)
                for p, found in enumerate(few.column("cells").to_pylist()):
                    for c in found:
                        tensor[p, :, c["bits"]] = [c[w] for w in WEIGHTS]
                tensor = tensor.reshape(few.num_rows, len(WEIGHTS), *(2,) * k)
                got = {m: contract(tensor, v) for m, v in picked.items()}
                removed = got["removed"][:, 0]
                by_filter = np.stack([removed[:, filters == a].sum(1) for a in range(k)], 1)
                columns = {"kept": got["kept"][:, 0], "removed": removed,
                           "redundant": got["failing"][:, 0] - removed,
                           "unique_fails": got["unique_fails"][:, 0],
                           "good_lost": got["removed"][:, 1], "toxic_lost": got["removed"][:, 2],
                           "shapley": by_filter[:, filters]}
                yield pa.RecordBatch.from_pydict({
                    "part": [x for x in few.column("part").to_pylist() for _ in steps],
                    "filter_order": names * few.num_rows,
                    "step": pa.array(steps * few.num_rows, pa.int32()),
                    **{c: v.ravel() for c, v in columns.items()}})

    return tensors.mapInArrow(run, _STEPS)
