"""Language-model scoring with Brown class-based bigrams.

``P(w | v) = P(class(w) | class(v)) * P(w | class(w))``, classes found by the
exchange algorithm: every word type moves to the class that raises the
likelihood of the class bigrams most.

* Counts cover every training token (distributed, partially aggregated).
* Words that make up at least ``MIN_SHARE`` of all training tokens are exchanged
  with a broadcast class table: there are at most ``1 / MIN_SHARE`` of them at
  any corpus size. The corpus is encoded once as type numbers. An exchange step
  scans it, gathers for a slice of the types how often each class stands before
  and after them, and moves the slice's types together. The likelihood of the
  next scan says whether that move helped; a move that lowered it is undone.
  Rounds over all slices go on until one adds little to what was gained so far.
* All rarer words that occur at least twice get a class of their own too, by the
  same gain, from the classes around their occurrences. Their number is not
  bounded, so occurrences, classes and counts stay in Spark: they meet by
  shuffles on the word's hash. During the exchange such a word stands in one of
  ``FAMILIES`` families by its ending.
* Words seen once and unseen words stay in their family, which is a member of a
  class; a word's probability inside its family comes from its count.

Words are told apart by 64-bit hashes. Every text ends with an end token, which
is also the context of its first word and keeps a class of its own.

Defined results: NULL and empty texts are the end token alone; a NULL id
counts as training; repeated rows count and are scored as often as they occur;
without training texts every token has the smoothing mass alone. Very long texts
are taken whole (a text is one row); of classes with equal gain a word keeps its
own, else the lowest number wins. Other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_and_raw
from kestrel.session import materialize

MIN_SHARE = 1e-6
#: A word needs this many occurrences for a class of its own.
LEAST_COUNT = 2
FAMILIES = 4096
CLASSES = 64
#: Parts of the types that move together; fixed, so that classes do not depend on the corpus size.
SLICES = 4
#: Rounds end when one adds less than this share of what all rounds gained.
LEAST_GAIN = 0.1
#: Count table a task adds to as a whole; larger ones are added to cell by cell.
DENSE_CELLS = 8_000_000
#: Context entries weighed at once (each against all classes).
WEIGHED = 20_000
#: Distinct words a task counts before it hands them on, and tokens it takes at once.
FLUSH_WORDS, FLUSH_TOKENS = 300_000, 2_000_000
#: Bytes of texts encoded together (or one text).
PORTION_BYTES = 1 << 20
#: The end token; no word holds a space.
END = b" "
END_HASH = xxhash.xxh3_64_intdigest(END) - 2**64 * (xxhash.xxh3_64_intdigest(END) >> 63)


def word_hash(word: bytes) -> int:
    """Signed 64-bit hash of a word."""
    h = xxhash.xxh3_64_intdigest(word)
    return h - 2**64 if h >> 63 else h


def family(word: bytes) -> int:
    """Family of a rare word: by its last three bytes."""
    return xxhash.xxh3_64_intdigest(word[-3:]) % FAMILIES


def tokens(raw: bytes) -> list[bytes]:
    words = raw.lower().split()
    words.append(END)
    return words


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """hash, family, n over all training texts (``docs``: doc_id, raw)."""
    schema = pa.schema([("hash", pa.int64()), ("family", pa.int32()), ("n", pa.int64())])

    def rows(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([word_hash(w) for w in c], pa.int64()),
             pa.array([family(w) for w in c], pa.int32()),
             pa.array(list(c.values()), pa.int64())], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for raw in b.column("raw"):
                c.update(tokens(raw.as_py()))
                if len(c) > FLUSH_WORDS:
                    yield rows(c)
                    c.clear()
        if c:
            yield rows(c)

    return (docs.filter(~is_held_out()).select("raw")
            .mapInArrow(run, "hash long, family int, n long")
            .groupBy("hash").agg(F.max("family").alias("family"), F.sum("n").alias("n")))


@dataclass
class Types:
    """Word types: 0 the end, then frequent words in hash order, then families."""

    hashes: np.ndarray
    counts: np.ndarray  # of all types; a family's: tokens of all its rarer words
    single: np.ndarray  # words of each family seen once
    total: int
    distinct: int

    @property
    def first_family(self) -> int:
        return 1 + len(self.hashes)

    def __len__(self) -> int:
        return len(self.counts)

    def of(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Type numbers of distinct words, given their hashes."""
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(words), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        out = (at + 1).astype(np.int32)
        for i in np.flatnonzero(~known).tolist():
            out[i] = 0 if words[i] == END else self.first_family + family(words[i])
        return out

    def base_log(self) -> np.ndarray:
        """log10 of the base probability of each type; families have none."""
        p = np.log10((self.counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))
        p[self.first_family:] = 0.0
        return p


def word_types(vocab: DataFrame, min_share: float = MIN_SHARE) -> Types:
    row = vocab.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = row["n"] or 0, row["v"]
    end = vocab.filter(F.col("hash") == END_HASH).agg(F.sum("n")).first()[0] or 0
    words = vocab.filter(F.col("hash") != END_HASH)
    limit = max(float(LEAST_COUNT), min_share * total)
    # at most 1 / min_share rows, and FAMILIES rows
    top = words.filter(F.col("n") >= limit).select("hash", "n").toPandas().sort_values("hash")
    rare = words.filter(F.col("n") < limit).groupBy("family").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") < LEAST_COUNT).alias("v")).toPandas()
    counts = np.zeros(1 + len(top) + FAMILIES, np.int64)
    counts[0] = end
    counts[1:1 + len(top)] = top["n"]
    of_family = rare["family"].to_numpy(np.int64)
    counts[1 + len(top) + of_family] = rare["n"]
    single = np.zeros(FAMILIES, np.int64)
    single[of_family] = rare["v"]
    return Types(top["hash"].to_numpy(np.int64), counts, single, int(total), int(distinct))


_CODED = ("uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
          "ids binary, rare array<long>, at binary")


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most PORTION_BYTES of text, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("raw")).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + PORTION_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary cell for each run of ``values`` that ends at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [
        None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def encode(docs: DataFrame, types) -> DataFrame:
    """Every text as type numbers, with the base score of its frequent tokens.

    ``rare``: hashes of the text's distinct words that stand in a family;
    ``at``: for each token of a family, its word's place in ``rare``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = types.value
        base = t.base_log()
        for batch in batches:
            for b in _portions(batch):
                texts = [tokens(raw) for raw in b.column("raw").to_pylist()]
                lengths = np.fromiter(map(len, texts), np.int64, len(texts))
                flat = list(chain.from_iterable(texts))
                words = list(dict.fromkeys(flat))
                number = dict(zip(words, range(len(words))))
                spot = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
                x = t.of(words, hashes)[spot]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                m = np.flatnonzero(x >= t.first_family)
                text = np.repeat(np.arange(len(texts)), lengths)[m]
                pair, place = np.unique(text * len(words) + spot[m], return_inverse=True)
                first = np.searchsorted(pair, np.arange(len(texts) + 1) * len(words))
                seen = (t.counts[x] > 0) & (x < t.first_family)
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid"), b.column("doc_id"), b.column("held_out"), pa.array(lengths),
                     pa.array(np.add.reduceat(seen.astype(np.int64), starts)),
                     pa.array(np.add.reduceat(base[x], starts)), _cut(x, ends),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)),
                                              pa.array(hashes[pair % len(words)])),
                     _cut((place - first[text]).astype(np.int32), np.cumsum(np.bincount(text, minlength=len(texts))))],
                    names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "ids", "rare", "at"])

    return docs.mapInArrow(run, _CODED)


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in a row, and where each cell of it starts and ends."""
    kind = np.dtype(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.empty(0, kind), np.zeros(len(column) + 1, np.int64)
    values = np.frombuffer(column.buffers()[2], kind, (offsets[-1] - offsets[0]) // kind.itemsize, offsets[0])
    return values, (offsets.astype(np.int64) - offsets[0]) // kind.itemsize


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Type numbers of many texts in a row; each text ends with the end type, the next one's context."""
    held, size = [], 0
    for b in batches:
        x = _flat(b.column("ids"), np.int32)[0]
        held.append(x)
        size += len(x)
        if size >= FLUSH_TOKENS:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _slices(batches: Iterable[pa.RecordBatch], most: int = 128) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, most):
            yield b.slice(lo, most)


#: A class neighbour and its count, as stored: counts below 256 take two bytes.
SMALL, LARGE = np.dtype([("i", "u1"), ("n", "u1")]), np.dtype([("i", "u1"), ("n", "<u4")])


def _packed(acc: np.ndarray, width: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Rows of a count table that have counts, each as packed cells of small and of large counts."""
    cells = np.flatnonzero(acc)
    rows, n = cells // width, acc[cells]
    own = np.unique(rows)
    out = []
    for kind, part in ((SMALL, n < 256), (LARGE, n >= 256)):
        body = np.empty(int(part.sum()), kind)
        body["i"], body["n"] = cells[part] % width, n[part]
        out.append(_cut(body, np.searchsorted(rows[part], own, "right")))
    return own, *out


def _add(acc: np.ndarray, cells: np.ndarray) -> np.ndarray:
    if len(acc) <= DENSE_CELLS:
        acc += np.bincount(cells, minlength=len(acc))
    else:
        cell, n = np.unique(cells, return_counts=True)
        acc[cell] += n
    return acc


def context_counts(coded: DataFrame, classes, n_types: int, n_classes: int, piece: int,
                   slices: int = SLICES) -> DataFrame:
    """One scan: packed rows for one slice of types, and rows -1 - class of class bigrams.

    The cells of a type count the classes before (0..C-1) and after it (C..2C-1).
    """
    width, own = 2 * n_classes, -(-n_types // slices)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = classes.value.astype(np.int64)
        acc, mat = np.zeros(own * width, np.int64), np.zeros(n_classes * n_classes, np.int64)
        for x in _streams(batches):
            c = cls[x]
            before = np.concatenate([[cls[0]], c[:-1]])
            mat += np.bincount(before * n_classes + c, minlength=len(mat))
            m = np.flatnonzero((x % slices == piece) & (x != 0))
            row = (x[m] // slices).astype(np.int64) * width
            _add(acc, np.concatenate([row + before[m], row + n_classes + c[m + 1]]))
        for table, w, number in ((acc, width, lambda r: r * slices + piece),
                                 (mat, n_classes, lambda r: -1 - r)):
            rows, small, large = _packed(table, w)
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(number(rows), pa.int64()), small, large],
                                                 names=["type", "small", "large"])

    return (coded.filter("NOT held_out").select("ids")
            .mapInArrow(run, "type long, small binary, large binary"))


def _unpack(batches: Iterable[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a partition's packed rows: types, then per entry the type's index, cell and count."""
    kinds, cells, counts = [], [], []
    for b in batches:
        for name, kind in (("small", SMALL), ("large", LARGE)):
            got, offsets = _flat(b.column(name), kind)
            kinds.append(np.repeat(b.column("type").to_numpy(), np.diff(offsets)))
            cells.append(got["i"].astype(np.int64))
            counts.append(got["n"].astype(np.float64))
    if not kinds:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.float64)
    types, at = np.unique(np.concatenate(kinds), return_inverse=True)
    return types, *_summed(at, np.concatenate(cells), np.concatenate(counts))


def _summed(at: np.ndarray, cell: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in (at, cell) order, one for each pair."""
    width = 2**16
    key, same = np.unique(at * width + cell, return_inverse=True)
    return key // width, key % width, np.bincount(same, n, len(key))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(mat: np.ndarray) -> float:
    """Log-likelihood of the class bigrams (without the part that no exchange changes)."""
    return float(_xlogx(mat).sum() - _xlogx(mat.sum(axis=0)).sum() - _xlogx(mat.sum(axis=1)).sum())


def best_classes(at: np.ndarray, cell: np.ndarray, n: np.ndarray, now: np.ndarray,
                 mat: np.ndarray) -> np.ndarray:
    """The class for each type, given class bigrams and the types' contexts.

    Entry ``i`` says that type ``at[i]`` (ascending) has ``n[i]`` neighbours of
    class ``cell[i]`` before it, or ``cell[i] - classes`` after it. The gain of a
    class is the change of the class-bigram likelihood when the type is taken out
    of its class ``now`` and put there; class 0 (the end) is never chosen.
    """
    out = now.copy()
    own, start = np.unique(at, return_index=True)
    stop = np.append(start[1:], len(at))
    size = mat.sum(axis=0)
    lo = 0
    while lo < len(own):
        hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + WEIGHED, "right")))
        part = slice(start[lo], stop[hi - 1])
        place = np.repeat(np.arange(hi - lo), stop[lo:hi] - start[lo:hi])
        out[own[lo:hi]] = _weigh(place, cell[part], n[part], now[own[lo:hi]], mat, size)
        lo = hi
    return out


def _weigh(place: np.ndarray, cell: np.ndarray, n: np.ndarray, now: np.ndarray, mat: np.ndarray,
           size: np.ndarray) -> np.ndarray:
    k, rows, entries = len(mat), np.arange(len(now)), np.arange(len(cell))
    before = cell < k
    m = np.empty((len(cell), k))
    m[before] = mat[cell[before]]
    m[~before] = mat.T[cell[~before] - k]
    m[entries, now[place]] = np.maximum(m[entries, now[place]] - n, 0)
    first = np.searchsorted(place, rows)
    gain = np.add.reduceat(_xlogx(m + n[:, None]) - _xlogx(m), first, axis=0)
    tokens_of = np.bincount(place, n * before, len(now))[:, None]
    rest = np.tile(size, (len(now), 1))
    rest[rows, now] = np.maximum(rest[rows, now] - tokens_of[:, 0], 0)
    gain -= 2 * (_xlogx(rest + tokens_of) - _xlogx(rest))
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[rows, best] > gain[rows, now] + 1e-9, best, now)


def class_bigrams(contexts: DataFrame, n_classes: int) -> np.ndarray:
    """The class-by-class counts of a scan (classes * classes numbers)."""
    rows = contexts.filter("type < 0")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, at, cell, n = _unpack(batches)
        yield pa.RecordBatch.from_arrays([pa.array(-1 - types[at], pa.int64()), pa.array(cell), pa.array(n)],
                                         names=["a", "b", "n"])

    sums = (rows.mapInArrow(run, "a long, b long, n double").groupBy("a", "b").agg(F.sum("n").alias("n")))
    mat = np.zeros((n_classes, n_classes))
    for r in sums.collect():
        mat[r["a"], r["b"]] = r["n"]
    return mat


def exchange(contexts: DataFrame, classes, mat: np.ndarray) -> DataFrame:
    """(type, class): where the scanned slice's types belong best."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, at, cell, n = _unpack(batches)
        new = best_classes(at, cell, n, classes.value[types].astype(np.int64), mat)
        yield pa.RecordBatch.from_arrays([pa.array(types), pa.array(new.astype(np.int32))],
                                         names=["type", "class"])

    return (contexts.filter("type >= 0").repartition("type")
            .mapInArrow(run, "type long, class int"))


def first_classes(types: Types, n_classes: int) -> np.ndarray:
    """Frequent types one after the other over the classes; class 0 is the end's."""
    cls = np.zeros(len(types), np.int16)
    order = np.argsort(-types.counts[1:], kind="stable") + 1
    cls[order] = 1 + np.arange(len(order)) % (n_classes - 1)
    return cls


def learn(coded: DataFrame, types: Types, n_classes: int = CLASSES,
          least_gain: float = LEAST_GAIN) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of all types by exchange, their bigram counts and the likelihood after each kept step."""
    sc = coded.sparkSession.sparkContext
    cls = kept = first_classes(types, n_classes)
    kept_mat, steps, piece = None, [], 0
    round_start = None
    while True:
        shared = sc.broadcast(cls)  # one small number per type
        scan = materialize(context_counts(coded, shared, len(types), n_classes, piece), "lm-contexts")
        mat = class_bigrams(scan, n_classes)
        now = likelihood(mat)
        if steps and now < steps[-1] - 1e-9 * abs(steps[-1]):
            cls = kept  # the last slice lost by moving together: undo it, scan the next one again
            shared.destroy()
            continue
        kept, kept_mat = cls, mat
        steps.append(now)
        if piece == 0:
            if round_start is not None and now - round_start <= least_gain * (now - steps[0]):
                shared.destroy()
                return kept, kept_mat, steps
            round_start = now
        moved = exchange(scan, shared, mat).toPandas()  # a slice's types
        shared.destroy()
        cls = cls.copy()
        cls[moved["type"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int16)
        piece = (piece + 1) % SLICES


def rare_occurrences(coded: DataFrame, classes, n_classes: int, first_family: int) -> DataFrame:
    """(hash, around) for every training token of a family.

    ``around`` packs the classes of the family, the token before and the token after.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = classes.value.astype(np.int64)
        for b in _slices(batches):
            x = _flat(b.column("ids"), np.int32)[0]
            m = np.flatnonzero(x >= first_family)
            if len(m):
                c = cls[x]
                before = np.concatenate([cls[:1], c[:-1]])  # a text's first token follows an end
                at, texts = _flat(b.column("at"), np.int32)
                rare = b.column("rare")
                place = np.repeat(rare.offsets.to_numpy()[:-1], np.diff(texts)) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rare.values.to_numpy()[place]),
                     pa.array(((c[m] * n_classes + before[m]) * n_classes + c[m + 1]).astype(np.int32))],
                    names=["hash", "around"])

    return (coded.filter("NOT held_out").select("ids", "rare", "at")
            .mapInArrow(run, "hash long, around int"))


def settle(occurrences: DataFrame, mat: np.ndarray) -> DataFrame:
    """hash, class, n of every rarer training word; class NULL for words seen less than LEAST_COUNT times.

    A partition is read in hash order; of a word that goes on in the next batch
    only counts (at most classes * classes) are held.
    """
    k = len(mat)

    def choose(h: np.ndarray, around: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        words, first = np.unique(h, return_index=True)
        count = np.add.reduceat(n, first)
        at = np.searchsorted(words, h)
        now, often = around[first] // (k * k), count >= LEAST_COUNT
        e = often[at]
        where = _summed(np.concatenate([at[e], at[e]]),
                        np.concatenate([around[e] // k % k, k + around[e] % k]), np.concatenate([n[e], n[e]]))
        best = best_classes(*where, now, mat)
        return pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(best.astype(np.int32), mask=~often), pa.array(count.astype(np.int64))],
            names=["hash", "class", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, around, n = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for b in batches:
            if not b.num_rows:
                continue
            h = np.concatenate([h, b.column("hash").to_numpy()])
            around = np.concatenate([around, b.column("around").to_numpy().astype(np.int64)])
            n = np.concatenate([n, np.ones(b.num_rows)])
            split = int(np.searchsorted(h, h[-1]))  # the last word may go on
            if split:
                yield choose(h[:split], around[:split], n[:split])
            cells, same = np.unique(around[split:], return_inverse=True)
            h, around, n = np.full(len(cells), h[-1]), cells, np.bincount(same, n[split:], len(cells))
        if len(h):
            yield choose(h, around, n)

    return (occurrences.repartition("hash").sortWithinPartitions("hash")
            .mapInArrow(run, "hash long, class int, n long"))


@dataclass
class Emissions:
    """log10 word probabilities: of types in their class, and what rarer words need."""

    classes: np.ndarray
    of_type: np.ndarray  # log10 P(type | class); families: of all words that stay in them
    class_mass: np.ndarray  # log10 of a class's tokens with smoothing
    family_mass: np.ndarray  # the same of a family
    first_family: int
    base_mass: float

    def rare(self, n: np.ndarray, own: np.ndarray, of_family: np.ndarray) -> np.ndarray:
        """Of rarer words with count ``n``, class ``own`` (-1: none) and family."""
        inside = self.of_type[self.first_family + of_family] - self.family_mass[of_family]
        return np.log10(n + 0.5) + np.where(own >= 0, -self.class_mass[own], inside)


def emissions(types: Types, cls: np.ndarray, tokens_of: np.ndarray, words_of: np.ndarray,
              add: float = 0.5) -> Emissions:
    """``tokens_of``, ``words_of``: what the rarer words add to each class."""
    counts, k = types.counts.astype(float), len(tokens_of)
    counts[types.first_family:] = types.single  # their other words have classes of their own
    mass = (np.bincount(cls, counts, k) + tokens_of) + add * (np.bincount(cls, minlength=k) + words_of)
    mass = np.log10(np.maximum(mass, 1e-300))
    of_type = np.log10(counts + add) - mass[cls]
    of_type[0] = 0.0
    family_mass = np.log10(types.single + add * (types.single + 1))
    return Emissions(cls, of_type, mass, family_mass, types.first_family,
                     float(np.log10(types.total + add * (types.distinct + 1))))


def transitions(mat: np.ndarray, add: float = 0.5) -> np.ndarray:
    """log10 P(class | class before), smoothed."""
    return np.log10((mat + add) / (mat.sum(axis=1, keepdims=True) + add * len(mat)))


#: Stands for the class of a token whose word must be looked up.
LATER = 255
_DRAFT = ("uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
          "emission double, classes binary, families binary, at binary")
_SPELLED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
            "emission double, classes binary")


def draft(coded: DataFrame, emission) -> DataFrame:
    """Every text as classes (a byte each), LATER where a rarer word stands, and their families."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = emission.value
        classes = e.classes.astype(np.uint8)
        log_of = e.of_type.copy()
        classes[e.first_family:], log_of[e.first_family:] = LATER, 0.0
        for b in _slices(batches):
            x, ends = _flat(b.column("ids"), np.int32)
            at, texts = _flat(b.column("at"), np.int32)
            slots = b.column("rare").offsets.to_numpy()
            place = np.repeat(slots[:-1] - slots[0], np.diff(texts)) + at
            families = np.empty(slots[-1] - slots[0], np.uint16)
            families[place] = x[x >= e.first_family] - e.first_family
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in ("uid", "doc_id", "held_out", "n_tokens", "known", "base")],
                 pa.array(np.add.reduceat(log_of[x], ends[:-1])), _cut(classes[x], ends[1:]),
                 _cut(families, slots[1:] - slots[0]), b.column("at")],
                names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "emission", "classes",
                       "families", "at"])

    return coded.mapInArrow(run, _DRAFT)


def spell(coded: DataFrame, words: DataFrame, emission) -> DataFrame:
    """Every text as classes, with its base score, n_known and the sum of its emissions.

    A text's rarer words meet their class and count by a shuffle on the hash (no
    word has more than a small share of the tokens) and come back to their text.
    What does not come back was seen once, in a training text, or else never.
    """
    found = (coded.select("uid", "held_out", F.posexplode("rare").alias("slot", "hash"))
             .join(words, "hash").filter("class IS NOT NULL OR held_out")
             .groupBy("uid").agg(F.collect_list(F.struct(  # a text's own distinct words
                 "slot", (F.col("n") * 256 + F.coalesce("class", F.lit(LATER))).alias("code"))).alias("found")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = emission.value
        own_class = e.classes[e.first_family:].astype(np.uint8)
        for b in _slices(batches):
            rows = b.num_rows
            spelled, ends = _flat(b.column("classes"), np.uint8)
            families, slots = _flat(b.column("families"), np.uint16)
            at, texts = _flat(b.column("at"), np.int32)
            held_out = b.column("held_out").to_numpy(zero_copy_only=False)
            n = np.repeat(np.where(held_out, 0, 1), np.diff(slots))
            own = np.full(len(families), -1)
            lists, body = b.column("found").offsets.to_numpy(), b.column("found").values
            body = body.slice(lists[0], lists[-1] - lists[0])
            slot, code = body.field(0).to_numpy(), body.field(1).to_numpy()
            place = np.repeat(slots[:-1], np.diff(lists)) + slot
            n[place] = code // 256
            own[place] = np.where(code % 256 == LATER, -1, code % 256)
            text = np.repeat(np.arange(rows), np.diff(texts))
            place = slots[text] + at
            count, mine, fam = n[place], own[place], families[place].astype(np.int64)
            spelled = spelled.copy()
            spelled[spelled == LATER] = np.where(mine >= 0, mine, own_class[fam])
            per_text = lambda v: np.bincount(text, v, rows)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), b.column("n_tokens"),
                 pa.array(b.column("known").to_numpy() + per_text(count > 0).astype(np.int64)),
                 pa.array(b.column("base").to_numpy() + per_text(np.log10(count + 0.5) - e.base_mass)),
                 pa.array(b.column("emission").to_numpy() + per_text(e.rare(count, mine, fam))),
                 _cut(spelled, ends[1:])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "classes"])

    return draft(coded, emission).join(found, "uid", "left").mapInArrow(run, _SPELLED)


def spelled_bigrams(spelled: DataFrame, n_classes: int) -> np.ndarray:
    """Class-by-class counts over the training texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mat = np.zeros(n_classes * n_classes, np.int64)
        for b in batches:
            c = _flat(b.column("classes"), np.uint8)[0].astype(np.int64)
            if len(c):  # every text ends with class 0, the next one's context
                mat += np.bincount(np.concatenate([[0], c[:-1]]) * n_classes + c, minlength=len(mat))
        cell = np.flatnonzero(mat)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(mat[cell])], names=["cell", "n"])

    sums = (spelled.filter("NOT held_out").select("classes").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")))
    mat = np.zeros(n_classes * n_classes)
    for r in sums.collect():  # at most classes * classes
        mat[r["cell"]] = r["n"]
    return mat.reshape(n_classes, n_classes)


def transition_scores(spelled: DataFrame, transition: np.ndarray) -> DataFrame:
    """doc_id, ..., score: emissions plus the class transitions of each text."""
    keep = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, ends = _flat(b.column("classes"), np.uint8)
            score = b.column("emission").to_numpy()
            if len(c):
                step = transition[np.concatenate([[0], c[:-1]]), c]
                score = score + np.add.reduceat(step, ends[:-1])
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(score)],
                                             names=[*keep, "score"])

    return spelled.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                   "base_score double, score double")


@dataclass
class Fitted:
    """The corpus as types, the types and their classes, and the rarer words (hash, class, n)."""

    coded: DataFrame
    types: Types
    classes: np.ndarray
    words: DataFrame
    steps: list[float]


def fit(docs: DataFrame, n_classes: int = CLASSES, min_share: float = MIN_SHARE,
        id_col: str = "doc_id", text_col: str = "text") -> Fitted:
    """Counts, exchange over the frequent words, classes of the rarer ones; at most 128 classes."""
    if not 2 <= n_classes <= 128:
        raise ValueError("n_classes must be between 2 and 128")
    sc = docs.sparkSession.sparkContext
    rows = id_and_raw(docs, id_col, text_col)
    types = word_types(materialize(count_words(rows), "lm-vocab"), min_share)
    table = sc.broadcast(types)  # at most 1 / min_share words and FAMILIES families
    numbered = rows.withColumns({"uid": F.monotonically_increasing_id(), "held_out": is_held_out()})
    coded = materialize(encode(numbered, table), "lm-coded")
    table.destroy()
    cls, mat, steps = learn(coded, types, n_classes)
    shared = sc.broadcast(cls)
    words = materialize(settle(rare_occurrences(coded, shared, n_classes, types.first_family), mat), "lm-words")
    shared.destroy()
    return Fitted(coded, types, cls, words, steps)


def score(docs: DataFrame, n_classes: int = CLASSES, min_share: float = MIN_SHARE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    model = fit(docs, n_classes, min_share, id_col, text_col)
    tokens_of, words_of = np.zeros(n_classes), np.zeros(n_classes)
    for r in (model.words.filter("class IS NOT NULL").groupBy("class")
              .agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()):  # one row per class
        tokens_of[r["class"]], words_of[r["class"]] = r["n"], r["v"]
    emission = docs.sparkSession.sparkContext.broadcast(
        emissions(model.types, model.classes, tokens_of, words_of))  # a few numbers per type
    spelled = materialize(spell(model.coded, model.words, emission), "lm-classes")
    emission.destroy()
    out = transition_scores(spelled, transitions(spelled_bigrams(spelled, n_classes)))
    return (out.withColumn("train_tokens", F.lit(model.types.total).cast("long"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
