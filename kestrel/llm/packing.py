"""Packing: concatenate all documents, cut the stream into fixed windows.

Pass 1 tokenizes each partition and stores the ids with each document's
offset inside its partition. Prefix sums over the partition totals (one row
per partition) give every document its place in the global stream. Pass 2
cuts documents at window borders; nothing but the totals is shuffled.

Defined results: NULL and empty texts are the end id alone; repeated rows are
packed as often as they occur, in the order of the scan (ties keep it too); a
document longer than a window has a piece in each window it crosses, and each
piece takes its own ids only, so the cut is linear in the longest text. Only the last window can be short. Other columns are
ignored; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import id_and_raw
from kestrel.llm.tokens import MEMO_ENTRIES, chunk_encoder
from kestrel.operators.joins import broadcast_if_bounded
from kestrel.session import arrow_rows, materialize

WINDOW = 2048
END_ID = 1

_TOKENS = "part int, start_in_part long, doc_id long, doc_tokens long, ids binary"


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
             id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO_ENTRIES) -> DataFrame:
    """One row per document: its ids (little-endian unsigned 32 bit) and its offset in the partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = chunk_encoder(tokenizer_path, memo), np.array([end_id], "<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                few = b.slice(lo, 256)
                ids = [encoder.encode(r) + end for r in few.column("raw").to_pylist()]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), part, np.int32)),
                    pa.array(at + np.cumsum(n) - n), few.column("doc_id"), pa.array(n),
                    pa.array(ids, pa.binary())],
                    names=["part", "start_in_part", "doc_id", "doc_tokens", "ids"])
                at += int(n.sum())

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, _TOKENS)


def partition_bases(tokens: DataFrame) -> DataFrame:
    """Where each partition begins in the stream: prefix sums over one row per partition."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary)."""
    # the smaller side has one row of two numbers per partition of the stored tokens
    placed = (tokens.join(broadcast_if_bounded(partition_bases(tokens)), "part")
              .withColumn("at", F.col("base") + F.col("start_in_part")))
    first, last = F.expr(f"at div {window}"), F.expr(f"(at + doc_tokens - 1) div {window}")

    def piece(ids, number):
        start = F.greatest(F.lit(0), number * window - F.col("at"))
        length = F.least(F.col("doc_tokens"), (number + 1) * window - F.col("at")) - start
        return F.struct(start.alias("start"), length.alias("length"), number.alias("sequence_id"),
                        (F.col("at") + start - number * window).alias("offset"),
                        F.substring(ids, (start * 4 + 1).cast("int"),
                                    (length * 4).cast("int")).alias("ids"))

    # cut before the rows multiply, from ids bound to a lambda variable: reading the column
    # itself would copy all ids of the document once for every piece
    pieces = F.flatten(F.transform(F.array("ids"), lambda ids: F.transform(
        F.sequence(first, last), lambda number: piece(ids, number))))
    return (placed.select("doc_id", "doc_tokens", F.inline(pieces))
            .select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO_ENTRIES) -> DataFrame:
    """All documents as pieces of gapless sequences of ``window`` tokens (see ``cut``).

    ``memo`` bounds the chunks a Python worker keeps; it changes no result.
    """
    with arrow_rows(docs.sparkSession):
        tokens = materialize(tokenize(docs, tokenizer_path, end_id, id_col, text_col, memo), "pack-tokens")
    return cut(tokens, window)


def sequences(pieces: DataFrame) -> DataFrame:
    """Windows put together: sequence_id, n_tokens, ids (binary). A group holds one window at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))
