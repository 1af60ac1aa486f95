"""Exact deduplication by composable polynomial fingerprints.

A text (A-Z lower-cased, as UTF-8 bytes) is a polynomial in 256 whose value
modulo a 128-bit prime is its fingerprint. Values of neighbouring chunks
combine by length-shifted arithmetic, ``H(ab) = H(a) * 256**len(b) + H(b)``,
so chunks of a huge text are hashed one by one, in any grouping. Texts with
equal length and fingerprint are then compared chunk by chunk with the text
that would stay, so a collision never merges different texts. Rows are told
apart by id and SHA-256 of the text, so different texts may stand under one id.

Defined results: NULL text counts as empty; all empty texts are one group.
Of equal texts the row with the largest id stays (a NULL id is below every
id); of repeated rows with that id exactly one stays. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_and_raw, keep_ids, only
from kestrel.session import materialize

#: The largest prime below 2**128.
PRIME = 2**128 - 159
CHUNK_BYTES = 1 << 20

_PRINTS = "doc_id long, uid long, n_bytes long, fp binary, text_sha256 string"
_CHUNKS = "n_bytes long, fp binary, doc_id long, text_sha256 string, k int, chunk binary"


def chunks(raw: bytes, size: int) -> list[bytes]:
    return [raw[i:i + size] for i in range(0, len(raw), size)] or [b""]


def chunk_hash(chunk: bytes, prime: int = PRIME) -> tuple[int, int]:
    """(value, length) of one chunk."""
    return int.from_bytes(chunk, "big") % prime, len(chunk)


def combine(a: tuple[int, int], b: tuple[int, int], prime: int = PRIME) -> tuple[int, int]:
    """(value, length) of two neighbouring chunks together; associative."""
    return (a[0] * pow(256, b[1], prime) + b[0]) % prime, a[1] + b[1]


def fingerprint(raw: bytes, prime: int = PRIME, size: int = CHUNK_BYTES) -> bytes:
    """16 bytes; independent of how the text is cut into chunks."""
    parts = [chunk_hash(c, prime) for c in chunks(raw, size)]
    return reduce(lambda a, b: combine(a, b, prime), parts)[0].to_bytes(16, "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, uid (row number in the scan), n_bytes, fp, text_sha256."""
    rows = id_and_raw(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            low = [r.lower() for r in b.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("uid"),
                pa.array([len(r) for r in low], pa.int64()),
                pa.array([fingerprint(r, prime, chunk_bytes) for r in low], pa.binary()),
                pa.array([hashlib.sha256(r).hexdigest() for r in low], pa.string())],
                names=["doc_id", "uid", "n_bytes", "fp", "text_sha256"])

    return rows.mapInArrow(run, _PRINTS)


def _chunk_rows(docs: DataFrame, id_col: str, text_col: str, prime: int,
                chunk_bytes: int) -> DataFrame:
    """Chunks of every text, each with the fingerprint of its whole text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n_bytes", pa.int64()), ("fp", pa.binary()), ("doc_id", pa.int64()),
                            ("text_sha256", pa.string()), ("k", pa.int32()), ("chunk", pa.binary())])
        for b in batches:
            out = []
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("raw").to_pylist()):
                low = raw.lower()
                fp, sha = fingerprint(low, prime, chunk_bytes), hashlib.sha256(low).hexdigest()
                out += [{"n_bytes": len(low), "fp": fp, "doc_id": doc_id, "text_sha256": sha, "k": k, "chunk": c}
                        for k, c in enumerate(chunks(low, chunk_bytes))]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, _CHUNKS)


def _groups(prints: DataFrame) -> DataFrame:
    """Per (length, fingerprint, class): the row that stays and the number of rows."""
    return (prints.groupBy("n_bytes", "fp", "cls")
            .agg(F.max(F.struct("doc_id", "uid", "text_sha256")).alias("top"), F.count("*").alias("group_size")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    The comparison joins the chunks of group members with the chunks of the
    text that stays, on (length, fingerprint, chunk number): an inner join
    whose side of members Spark can split, so a group of copies that holds a
    third of all rows is spread over tasks. Members that differ (a
    collision) form a class of their own and are compared again.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, prime, chunk_bytes)
                         .withColumn("cls", F.lit(0)), "exact-prints")
    key = ["n_bytes", "fp"]
    row = [*key, "doc_id", "text_sha256"]

    def same(a: str, b: str, cols: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])

    open_, again = prints, False
    while True:
        multi = (_groups(open_).filter("group_size > 1")
                 .select(*key, F.col("top.doc_id").alias("top_id"), F.col("top.text_sha256").alias("top_sha")))
        members = open_.join(multi, key, "left_semi")
        texts = keep_ids(docs, members, id_col)
        rows = _chunk_rows(texts, id_col, text_col, prime, chunk_bytes)
        if again:
            # other texts of these ids may already stand in an earlier class
            rows = rows.alias("r").join(members.select(*row).distinct().alias("m"), same("r", "m", row), "left_semi")
        mine = rows.join(multi, key)
        top = (mine.filter(F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("text_sha256") == F.col("top_sha")))
               .select(*key, "k", F.col("chunk").alias("top_chunk")).dropDuplicates([*key, "k"]))
        differ = (mine.select(*row, "k", "chunk").join(top, [*key, "k"])
                  .filter(F.col("chunk") != F.col("top_chunk")).select(*row).distinct())
        differ = materialize(differ, "exact-differ")
        if differ.isEmpty():
            break
        moved = prints.alias("p").join(differ.alias("d"), same("p", "d", row), "left")
        prints = materialize(
            moved.select("p.doc_id", "p.uid", "p.n_bytes", "p.fp", "p.text_sha256",
                         F.when(F.col("d.fp").isNull(), F.col("p.cls"))
                         .otherwise(F.col("p.cls") + 1).alias("cls")), "exact-prints")
        open_ = prints.join(differ.select(*key).distinct(), key, "left_semi")
        open_, again = open_.filter(F.col("cls") == open_.agg(F.max("cls")).first()[0]), True
    out = prints.join(_groups(prints), [*key, "cls"])
    return out.select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("uid") == F.col("top.uid")))
        .alias("kept"), "text_sha256", "n_bytes")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies: all columns of the rows that stay.

    Ids that occur once are joined back by id. Rows of an id that occurs
    several times are told apart by their normalised text.
    """
    verdict = materialize(exact_dedup(docs, id_col, text_col)
                          .select("doc_id", "kept", "text_sha256"), "exact-verdict")
    kept = verdict.filter("kept")
    repeated = materialize(verdict.groupBy("doc_id").count().filter("count > 1")
                           .select("doc_id"), "exact-repeated")
    if repeated.isEmpty():
        return keep_ids(docs, kept, id_col)
    sha = F.sha2(F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")),
                             "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)
    tagged = docs.withColumns({"_sha": sha, "_kid": F.col(f"`{id_col}`").cast("long")})
    own = kept.select(F.col("doc_id").alias("_k"), F.col("text_sha256").alias("_s"))
    return (tagged.join(own, F.col("_kid").eqNullSafe(F.col("_k")) & (F.col("_sha") == F.col("_s")),
                        "left_semi")
            .dropDuplicates(["_kid", "_sha"]).drop("_sha", "_kid"))
