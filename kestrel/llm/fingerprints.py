"""Document fingerprints: digests of a text's improbable byte windows.

1. Rarity. Every 32-byte window of a text falls into one of 1001 classes by
   its Shannon entropy. Classes are ranked by how seldom they occur in all
   documents (``rarity_ranks``: one number per class). Windows of very low
   entropy (fillers, runs of one letter) rank last.
2. Selection. In every neighbourhood of 32 consecutive windows (shorter ones
   at both ends of a text) the first of the rarest windows gets a vote;
   windows with at least 8 votes are the features. A text without such a
   window has its most voted one; a text shorter than a window is one feature.
3. Digest. Distinct features in text order fill Bloom filters of 2048 bits, 5
   bits a feature, 128 features a filter; a full filter starts the next one of
   the chain.
4. Likeness. The bits that two filters share, less what two unrelated filters
   of these sizes share by chance, normalised to 1 for a filter held by the
   other one, estimate the share of features in common; what lies within
   four standard deviations of chance counts as none. Summed over the other
   chain, this is the share of a chain's features that the other one has; the
   likeness is the lesser of the two directions.

Entropy is kept in whole numbers: with ``g(c) = c log2 c`` scaled to integers,
moving the window by one byte changes the sum of ``g`` by what the byte that
leaves and the byte that enters contribute, and both depend only on how often
these bytes occur among their next and previous 31 neighbours.

``fingerprints`` compares each document with the next one by id and with an
edited text. Rows are range-partitioned by (id, text hash, row) and sorted, so
a pass over each partition sees neighbours side by side; only the first and the
last row of each partition are stored with their texts and joined with the
partition beside it.

Defined results: NULL text counts as empty; an empty text has no features, an
empty fingerprint and likeness 1 to another empty one, 0 to any other. NULL
ids stand before all others; rows of one id are ordered by a hash of their
text, equal rows in any order. The next document of the last row is the first
row; a single row is its own next one. An empty table gives an empty result
and ranks by class number. A very long text is handled in blocks of 2^18
windows and short ones are joined for a pass of array operations; neither changes
a result. A comparison of two chains
costs the product of their lengths (0.01 s for two texts of 1 MB). Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import id_and_raw, only
from kestrel.session import materialize

WINDOW = 32
NEIGHBOURS = 32
VOTES = 8
CLASSES = 1000
#: Windows of at most this class rank behind all others.
LOW_CLASS = 300
FILTER_BITS, FEATURE_BITS, PER_FILTER = 2048, 5, 128
SIGMAS = 4.0
BLOCK = 1 << 18
#: Texts are joined up to so many bytes for one pass of array operations.
JOINED = 1 << 17

_ONE = 1 << 16
_G = np.array([round(c * math.log2(c) * _ONE) if c else 0 for c in range(WINDOW + 1)], np.int64)
_STEP = np.diff(_G).astype(np.int32)
_LAST = CLASSES + 1
_OUTSIDE = CLASSES + 2
_POS_BITS = 20

# Results are stored as bytes; text is made of them at the end.
_RESULT = ("doc_id long, n_chars long, sha binary, n long, bits binary, edited_n long, "
           "edited_bits binary, near_edited double, near_next double")


# ------------------------------------------------------------------ windows
def window_classes(x: np.ndarray) -> np.ndarray:
    """Entropy class (0 to 1000) of every window of a byte array with at least one."""
    before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for lag in range(1, WINDOW):
        same = (x[lag:] == x[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    total = np.cumsum(_STEP[before], dtype=np.int64)
    total[WINDOW:] -= np.cumsum(_STEP[after[:-WINDOW]], dtype=np.int64)
    return (CLASSES - total[WINDOW - 1:] * CLASSES // _G[WINDOW]).astype(np.int16)


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    """Bounds of the blocks that ``n`` windows or neighbourhoods are handled in."""
    for lo in range(0, n, BLOCK):
        yield lo, min(lo + BLOCK, n)


def together(raws: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined up to about ``JOINED`` bytes: their numbers, the bytes, each text's start and end."""
    some: list[int] = []
    size = 0
    for i, raw in enumerate(raws):
        some.append(i)
        size += len(raw)
        if size >= JOINED or i + 1 == len(raws):
            ends = np.cumsum([len(raws[j]) for j in some])
            yield some, np.frombuffer(b"".join([raws[j] for j in some]), np.uint8), \
                ends - [len(raws[j]) for j in some], ends
            some, size = [], 0


def _classes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every window of joined texts; -1 where a window lies over the end of a text."""
    n = len(x) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    found = np.concatenate([window_classes(x[lo:hi + WINDOW - 1]) for lo, hi in _blocks(n)])
    inside = np.zeros(n + 1, np.int8)
    has = ends - starts >= WINDOW
    inside[starts[has]] += 1
    inside[ends[has] - WINDOW + 1] -= 1
    found[np.cumsum(inside[:-1], dtype=np.int8) == 0] = -1
    return found


def class_counts(raws: list[bytes]) -> np.ndarray:
    """Windows of all texts by class."""
    total = np.zeros(CLASSES + 1, np.int64)
    for _, x, starts, ends in together(raws):
        total += np.bincount(_classes(x, starts, ends) + 1, minlength=CLASSES + 2)[1:]
    return total


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the rarest first (ties by class); low classes last."""
    ranks = np.empty(CLASSES + 1, np.int16)
    ranks[np.lexsort((np.arange(CLASSES + 1), counts))] = np.arange(CLASSES + 1)
    ranks[:LOW_CLASS + 1] = _LAST
    return ranks


def _votes(of: np.ndarray) -> np.ndarray:
    """Votes of every window; ``of`` holds ranks, ``_OUTSIDE`` where no text has a window.

    Texts have at least NEIGHBOURS - 1 places without a window between them, so
    no neighbourhood reaches from one text into another.
    """
    pad = np.full(NEIGHBOURS - 1, _OUTSIDE, np.int16)
    padded = np.concatenate([pad, of, pad])
    votes = np.zeros(len(padded), np.uint8)  # at most NEIGHBOURS each
    for lo, hi in _blocks(len(padded) - NEIGHBOURS + 1):
        ranks = padded[lo:hi + NEIGHBOURS - 1].astype(np.int32)
        key = (ranks << _POS_BITS) | np.arange(len(ranks), dtype=np.int32)
        width = 1
        while width < NEIGHBOURS:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        won = np.bincount(key & ((1 << _POS_BITS) - 1), minlength=len(ranks))
        votes[lo:lo + len(ranks)] += won.astype(np.uint8)
    return np.where(of == _OUTSIDE, 0, votes[len(pad):len(votes) - len(pad)])


# ------------------------------------------------------------------- digest
def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _hashes(rows: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of WINDOW bytes."""
    words = np.ascontiguousarray(rows).view("<u8")
    h = salt.astype(np.uint64)
    for i in range(words.shape[1]):
        h = _scramble((h + words[:, i]) * np.uint64(0x9E3779B97F4A7C15))
    return h


def feature_hashes(raws: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Per text: 64-bit hashes of its distinct features, in text order."""
    out: list[np.ndarray] = []
    place = np.append(ranks, _OUTSIDE).astype(np.int16)  # class -1 reads the last entry
    for some, x, starts, ends in together(raws):
        of = place[_classes(x, starts, ends)]
        votes = _votes(of)
        at = np.flatnonzero((votes >= VOTES) & (of != _LAST))
        found = np.zeros(0, np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(x, WINDOW) if len(of) else None
        if len(at):
            found = _hashes(windows[at], np.full(len(at), WINDOW))
        lo, hi = np.searchsorted(at, starts), np.searchsorted(at, ends)
        for k, i in enumerate(some):
            size, mine = len(raws[i]), found[lo[k]:hi[k]]
            if not len(mine) and size >= WINDOW:
                best = starts[k] + np.argmax(votes[starts[k]:ends[k] - WINDOW + 1])
                mine = _hashes(windows[best:best + 1], np.full(1, WINDOW))
            elif not len(mine) and size:
                short = np.frombuffer(raws[i].ljust(WINDOW, b"\0"), np.uint8)[None, :]
                mine = _hashes(short, np.full(1, size))
            if len(mine) > 1:
                mine = mine[np.sort(np.unique(mine, return_index=True)[1])]
            out.append(mine)
    return out


def filters(hashes: np.ndarray) -> np.ndarray:
    """(chain, FILTER_BITS) of 0 / 1: the features in order, PER_FILTER to a filter."""
    chain = np.zeros((-(-len(hashes) // PER_FILTER), FILTER_BITS), np.uint8)
    row = np.arange(len(hashes)) // PER_FILTER
    for i in range(FEATURE_BITS):
        chain[row, (hashes >> np.uint64(12 * i)).astype(np.int64) % FILTER_BITS] = 1
    return chain


def digests(raws: list[bytes], ranks: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Per text: number of features and chain of filters."""
    return [(len(h), filters(h)) for h in feature_hashes(raws, ranks)]


def packed(print_: tuple[int, np.ndarray]) -> bytes:
    """The chain's bits, filter after filter."""
    return np.packbits(print_[1], axis=1).tobytes()


def as_text(print_: tuple[int, np.ndarray]) -> str:
    """``<features>:<base64 of the chain>``; empty for an empty text."""
    return f"{print_[0]}:{base64.b64encode(packed(print_)).decode()}" if print_[0] else ""


def from_text(text: str) -> tuple[int, np.ndarray]:
    n, _, packed = text.partition(":")
    raw = np.frombuffer(base64.b64decode(packed), np.uint8).reshape(-1, FILTER_BITS // 8)
    return int(n or 0), np.unpackbits(raw, axis=1)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of features in common, 0 to 1, from the overlap of the filters."""
    (n_a, chain_a), (n_b, chain_b) = a, b
    if n_a == n_b and np.array_equal(chain_a, chain_b):
        return 1.0
    if not n_a or not n_b:
        return 0.0
    shared = chain_a.astype(np.float32) @ chain_b.astype(np.float32).T
    own, other = chain_a.sum(1, dtype=np.float64)[:, None], chain_b.sum(1, dtype=np.float64)[None, :]
    chance = own * other / FILTER_BITS
    spread = np.sqrt(chance * (1 - own / FILTER_BITS) * (1 - other / FILTER_BITS))
    excess = np.where(shared > chance + SIGMAS * spread, shared - chance, 0.0)

    def held(of: np.ndarray, n: int, axis: int) -> float:
        counts = np.minimum(PER_FILTER, n - PER_FILTER * np.arange(-(-n // PER_FILTER)))
        return float((np.minimum((excess / (of - chance)).sum(axis), 1.0) * counts).sum() / n)

    return min(held(own, n_a, 1), held(other, n_b, 0))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# -------------------------------------------------------------------- Spark
def rarity_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks of the entropy classes over all texts (see ``ranks_of``)."""
    raws = id_and_raw(docs.withColumn("_no_id", F.lit(None).cast("long")), "_no_id", text_col).select("raw")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        total = np.zeros(CLASSES + 1, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                total += class_counts(b.column("raw").slice(lo, 256).to_pylist())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["class", "n"])

    counts = np.zeros(CLASSES + 1, np.int64)
    for c, n in raws.mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n")).collect():
        counts[c] = n  # at most 1001 rows
    return ranks_of(counts)


def _results(rows: list[tuple], ranks: np.ndarray) -> list[dict]:
    """Results of (doc_id, raw, print, raw of the next, print of the next)."""
    texts = [raw.decode() for _, raw, *_ in rows]
    new = [edited(t, row[3].decode()).encode() for t, row in zip(texts, rows)]
    prints = digests(new, ranks)
    return [{"doc_id": doc_id, "n_chars": len(text), "sha": hashlib.sha256(raw).digest(),
             "n": own[0], "bits": packed(own), "edited_n": changed[0], "edited_bits": packed(changed),
             "near_edited": likeness(own, changed), "near_next": likeness(own, following)}
            for (doc_id, _, own, _, following), text, raw, changed in zip(rows, texts, new, prints)]


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    if ranks is None:
        ranks = rarity_ranks(docs, text_col)
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc(), F.col("_row").asc()]
    rows = (id_and_raw(docs, id_col, text_col)
            .withColumns({"_hash": F.xxhash64("raw"), "_row": F.monotonically_increasing_id()})
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "raw"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("sha", pa.binary()),
                        ("n", pa.int64()), ("bits", pa.binary()), ("edited_n", pa.int64()),
                        ("edited_bits", pa.binary()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64())])
    edge_schema = pa.schema([*schema, ("part", pa.int32()), ("edge", pa.string()), ("raw", pa.binary())])

    def pass_over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                few = b.slice(lo, 256)
                raws = few.column("raw").to_pylist()
                rows = list(zip(few.column("doc_id").to_pylist(), raws, digests(raws, ranks)))
                out = [] if last else [{"part": part, "edge": "head", "raw": raws[0]}]
                line = [last, *rows] if last else rows
                out += _results([(*a, *c[1:]) for a, c in zip(line, line[1:])], ranks)
                last = rows[-1]
                yield pa.RecordBatch.from_pylist(out, schema=edge_schema)
        if last:
            yield pa.RecordBatch.from_pylist([{"doc_id": last[0], "part": part, "edge": "tail", "raw": last[1]}],
                                             schema=edge_schema)

    def over_edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            for lo in range(b.num_rows):
                doc_id, raw, head = (b.column(c)[lo].as_py() for c in ("doc_id", "raw", "head"))
                own, following = digests([raw, head], ranks)
                yield pa.RecordBatch.from_pylist(_results([(doc_id, raw, own, head, following)], ranks),
                                                 schema=schema)

    done = materialize(rows.mapInArrow(pass_over, _RESULT + ", part int, edge string, raw binary"), "prints", "zstd")
    heads = done.filter("edge = 'head'")
    # the partition after each one, around the end: one number per partition
    along = Window.orderBy("part")
    after = heads.select("part").select("part", F.lead("part").over(along).alias("_next"),
                                        F.first("part").over(along).alias("_start"))
    after = after.select("part", F.coalesce("_next", "_start").alias("_next"))
    tails = (done.filter("edge = 'tail'").select("part", "doc_id", "raw").join(after, "part")
             .join(heads.select(F.col("part").alias("_next"), F.col("raw").alias("head")), "_next")
             .select("doc_id", "raw", "head"))
    whole = (done.filter("edge IS NULL").drop("part", "edge", "raw")
             .unionByName(tails.mapInArrow(over_edges, _RESULT)))

    def text(n: str, bits: str):
        line = F.translate(F.base64(bits), "\r\n", "")  # some releases break base64 into lines
        return F.when(F.col(n) > 0, F.concat_ws(":", F.col(n), line)).otherwise("")

    return whole.select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
                        text("n", "bits").alias("fingerprint"),
                        text("edited_n", "edited_bits").alias("edited_fingerprint"), "near_edited", "near_next")
