"""Near-duplicate groups by a MinHash LSH forest.

Each text (A-Z lower-cased) is the set of its distinct word shingles, held as
64-bit hashes. ``TREES`` signature orders of ``DEPTH`` min-hashes each act as
sorted prefix trees: documents that share a prefix of a tree are neighbours.

1. Equal sets are collapsed to one representative, which gets a number of its
   own: different texts under one id are different representatives.
2. Regions (shared prefixes of depth 3, 5, 8) link their members to the
   region's most central member: one link per member and tree, however large
   the region is. The best link of each document is confirmed on full sets.
3. Documents still in different components are linked to other hubs and to
   their neighbours in the sorted orders, and confirmed. What is open after
   that is compared: all pairs of a small shallow region; documents of large
   ones by a prefix-filter join on their rarest shingles, which finds every
   similar pair. Where many share such a shingle, every component meets its
   largest one, member by member inside a join. Regions and shingles that
   already are in one component are skipped, which keeps a huge group of near
   copies linear.
4. Pairs whose sizes and sketches (two bits of each min-hash) allow the
   similarity are confirmed on full sets.

Defined results: NULL or empty texts and texts without a word have no
shingles, stay alone and are kept; a text shorter than a shingle is one
shingle; rows with a NULL id are returned with a NULL component and kept;
repeated rows are alike; rows of one id with different texts each get the
component of their own text. A text of any length is one set, held by one task
at a time; of regions' members that tie, any may become the hub. Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import Memo, id_and_raw, keep_ids, only
from kestrel.llm.components import components
from kestrel.session import materialize

TREES, DEPTH = 16, 8
#: Prefix depths at which regions are looked at, shallow to deep.
LEVELS = (3, 5, 8)
#: A region with at most so many members is compared in full; a larger one through rare shingles.
REGION = 64
#: Sketches may differ by so many standard deviations more than the threshold implies.
SKETCH_SIGMAS = 4.5

_K = TREES * DEPTH
_RNG = np.random.Generator(np.random.PCG64(7))
_MUL = _RNG.integers(1, 2**32, _K, np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 2**32, _K, np.uint32)
_WORDS = Memo(xxhash.xxh3_64_intdigest, 300_000)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(raw: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(width, len(h))
    acc = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - size + 1 + j])
    return np.unique(acc)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` min-hashes of a set that is not empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(_K, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at:at + 4096]
        best = np.minimum(best, ((part[None, :] ^ _XOR[:, None]) * _MUL[:, None]).min(axis=1))
    return best


def _sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits per min-hash, in two planes of two signed 64-bit numbers a row each."""
    planes = [((sig * np.uint32(m)) >> np.uint32(31)).astype(np.uint8) for m in (0x9E3779B1, 0x85EBCA77)]
    return np.hstack([np.packbits(bits, axis=1).view("<i8") for bits in planes])


def _prefix_keys(sig: np.ndarray) -> dict[int, np.ndarray]:
    """For each level, the key of every row's prefix in every tree."""
    trees = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), trees.shape[:2]).copy()
    keys = {}
    for d in range(DEPTH):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + trees[:, :, d])
        if d + 1 in LEVELS:
            keys[d + 1] = acc.view(np.int64)
    return keys


SKETCH = ("sk1", "sk2", "sk3", "sk4")
_SIGNED = ("doc_id long, n_shingles long, set_hash binary, " + "".join(f"{c} long, " for c in SKETCH)
           + ", ".join(f"k{d} array<long>" for d in LEVELS))


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per document: set size, a 128-bit hash of the set, sketch and the keys of all trees."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(_WORDS)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                n, hashes, sigs = [], [], np.zeros((b.num_rows, _K), np.uint32)
                for i, raw in enumerate(b.column("raw").to_pylist()):
                    s = shingle_set(raw, width)
                    n.append(len(s))
                    hashes.append(xxhash.xxh3_128_digest(s.tobytes()))
                    if len(s):
                        sigs[i] = signature(s)
                sk, keys = _sketches(sigs), _prefix_keys(sigs)
                offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * TREES)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()),
                     *[pa.array(sk[:, j].copy()) for j in range(len(SKETCH))],
                     *[pa.ListArray.from_arrays(offsets, pa.array(keys[d].ravel())) for d in LEVELS]],
                    names=["doc_id", "n_shingles", "set_hash", *SKETCH, *[f"k{d}" for d in LEVELS]])

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, _SIGNED)


def shingle_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, set_hash, set): the full set of every document as an array of longs."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(_WORDS)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                sets = [shingle_set(r, width).view(np.int64) for r in b.column("raw").to_pylist()]
                hashes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(hashes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "set_hash", "set"])

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, "doc_id long, set_hash binary, set array<long>")


def sketch_limit(percent: int) -> int:
    """Differing min-hashes a pair at the similarity threshold shows at most, but for rare chance.

    Two different min-hashes have equal sketch bits once in four times.
    """
    p = (1 - percent / 100) * 3 / 4
    return math.ceil(_K * p + SKETCH_SIGMAS * math.sqrt(_K * p * (1 - p)))


def _near(a: str, b: str, percent: int) -> Column:
    """Whether sizes allow the similarity (an exact bound) and sketches do not rule it out."""
    def differ(low, high):
        return (F.col(f"{a}.{low}").bitwiseXOR(F.col(f"{b}.{low}"))
                .bitwiseOR(F.col(f"{a}.{high}").bitwiseXOR(F.col(f"{b}.{high}"))))

    bits = F.bit_count(differ("sk1", "sk3")) + F.bit_count(differ("sk2", "sk4"))
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (bits <= sketch_limit(percent))


def confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (``sets``: id, set) reach the similarity."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    united = F.size("sa") + F.size("sb") - shared
    return both.filter(100 * shared >= percent * united).select("a", "b")


def _tree_rows(reps: DataFrame) -> DataFrame:
    """A row per representative and tree, only of trees whose shallowest region has company."""
    keys = F.arrays_zip(*[F.col(f"k{d}") for d in LEVELS])
    rows = (reps.select("id", "n_shingles", *SKETCH, F.explode(keys).alias("k"))
            .select("id", "n_shingles", *SKETCH, *[F.col(f"k.k{d}").alias(f"k{d}") for d in LEVELS]))
    top = f"k{LEVELS[0]}"
    shared = rows.groupBy(top).agg(F.count("*").alias("n")).filter("n > 1").select(top)
    return rows.join(shared, top)


def _star_links(trees: DataFrame, percent: int) -> DataFrame:
    """(a, b, central): every member of a region linked to its most central member.

    A document's centrality is the number of documents that share its deepest
    regions; the origin of a group of edited copies has the most.
    """
    deep = f"k{LEVELS[-1]}"
    sizes = trees.groupBy(deep).agg((F.count("*") - 1).alias("n"))
    central = trees.join(sizes, deep).groupBy("id").agg(F.sum("n").alias("central"))
    rows = trees.join(central, "id")
    links = None
    for d in LEVELS:
        key = f"k{d}"
        hubs = (rows.groupBy(key).agg(F.max(F.struct(
            "central", (-F.col("id")).alias("neg"), "n_shingles", *SKETCH)).alias("h"))
            .select(key, (-F.col("h.neg")).alias("hub"), "h.central", "h.n_shingles",
                    *[f"h.{c}" for c in SKETCH]))
        level = (trees.alias("x").join(hubs.alias("y"), (F.col(f"x.{key}") == F.col(f"y.{key}"))
                                       & (F.col("x.id") != F.col("y.hub")) & _near("x", "y", percent))
                 .select(F.col("x.id").alias("a"), F.col("y.hub").alias("b"), F.col("y.central").alias("central")))
        links = level if links is None else links.union(level)
    return links.distinct()


#: Rows of one region that are sorted together to find neighbours.
SORTED_ROWS = 4096


def _neighbour_links(trees: DataFrame, percent: int) -> DataFrame:
    """(a, b): neighbours in the sorted order of a tree that are in different components.

    Inside a shallow region, rows that share a longer prefix stand together.
    A large region is dealt out by its next level, so no task sorts it whole.
    """
    top, mid, deep = (f"k{d}" for d in LEVELS)
    size = trees.groupBy(top).agg(F.count("*").alias("n"), F.min("comp").alias("lo"),
                                  F.max("comp").alias("hi")).filter("lo <> hi").select(top, "n")
    deal = F.pmod(F.col(mid), F.ceil(F.col("n") / SORTED_ROWS))
    order = Window.partitionBy(top, deal).orderBy(mid, deep, "id")
    me = ("id", "comp", "n_shingles", *SKETCH)
    links = None
    for ahead in (1, 2):
        near = (trees.join(size, top)
                .select(F.struct(*me).alias("x"), F.lead(F.struct(*me), ahead).over(order).alias("y"))
                .filter((F.col("x.comp") != F.col("y.comp")) & _near("x", "y", percent))
                .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
        links = near if links is None else links.union(near)
    return links


def _open_pairs(trees: DataFrame, percent: int, region: int) -> tuple[DataFrame, DataFrame]:
    """What is open between documents of different components that share a shallow region.

    Pairs (a, b) of the regions with at most ``region`` members, and the
    documents (id, comp, size, sketch) that stand in a larger one.
    """
    key = f"k{LEVELS[0]}"
    mixed = (trees.groupBy(key).agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo <> hi").select(key, "n"))
    rows = trees.join(mixed, key)
    here = rows.filter(F.col("n") <= region)
    x, y = here.alias("x"), here.alias("y")
    pairs = (x.join(y, (F.col(f"x.{key}") == F.col(f"y.{key}"))
                    & (F.col("x.comp") < F.col("y.comp")) & _near("x", "y", percent))
             .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    wide = rows.filter(F.col("n") > region).select("id", "comp", "n_shingles", *SKETCH).distinct()
    return pairs, wide


#: Counters that order shingles by rarity; shingles that share one are ordered by their hash.
RARITY_SLOTS = 1 << 20


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many sets hold the shingles of each slot: RARITY_SLOTS numbers at any input size."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(RARITY_SLOTS, np.int64)
        for b in batches:
            flat = b.column("set").flatten().to_numpy()
            acc += np.bincount(flat & (RARITY_SLOTS - 1), minlength=RARITY_SLOTS)
        slots = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(acc[slots])], names=["slot", "n"])

    got = (sets.select("set").mapInArrow(run, "slot long, n long")
           .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(RARITY_SLOTS, np.uint32)
    counts[got.column("slot").to_numpy()] = np.minimum(got.column("n").to_numpy(), 2**32 - 1)
    return counts


def _prefixes(sets: DataFrame, rarity, percent: int) -> DataFrame:
    """(id, token, left): the rarest shingles of each set, and how many it holds from there on.

    Sets that reach the similarity share a shingle among these, in any one
    order of all shingles (prefix filter).
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for b in batches:
            offsets = b.column("set").offsets.to_numpy()
            flat = b.column("set").values.to_numpy()
            tokens, left = [], []
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                s, n = flat[lo:hi], int(hi - lo)
                most = n - -(-percent * n // 100) + 1
                tokens.append(s[np.lexsort((s, counts[s & (RARITY_SLOTS - 1)]))[:most]])
                left.append(n - np.arange(len(tokens[-1]), dtype=np.int64))
            if tokens:
                ids = np.repeat(b.column("id").to_numpy(), [len(t) for t in tokens])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.concatenate(tokens)), pa.array(np.concatenate(left))],
                    names=["id", "token", "left"])

    return sets.select("id", "set").mapInArrow(run, "id long, token long, left long")


def _reach(left: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether sets that share at most ``left`` shingles can be similar (positional filter)."""
    return left * (100 + percent) >= percent * (na + nb)


def _wide_pairs(wide: DataFrame, sets: DataFrame, percent: int, region: int) -> tuple[DataFrame, DataFrame]:
    """All that is open between the documents of large regions, by a prefix-filter join.

    Pairs (a, b) that share a rare shingle. Where more than ``region``
    documents share it, those outside its largest component give pairs among
    each other, and meetings (ca, cb) of their components with the largest one.
    """
    mine = sets.join(wide.select("id"), "id", "left_semi")
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(mine))
    rows = (_prefixes(mine, rarity, percent)
            .join(wide.select("id", "comp", "n_shingles"), "id"))
    rows = materialize(rows, "near-prefixes")
    mixed = (rows.groupBy("token").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo <> hi").select("token", "n"))
    rows = rows.join(mixed, "token")
    hot = rows.filter(F.col("n") > region)
    parts = hot.groupBy("token", "comp").agg(
        F.count("*").alias("k"), F.max("left").alias("far"), F.min("n_shingles").alias("least"),
        F.max("n_shingles").alias("most"))
    big = (parts.groupBy("token").agg(F.max(F.struct("k", (-F.col("comp")).alias("neg"), "far", "least", "most")).alias("m"))
           .select("token", (-F.col("m.neg")).alias("big"), "m.far", "m.least", "m.most"))
    others = hot.join(big, "token").filter("comp <> big")
    n = F.col("n_shingles")
    meetings = (others.filter(_reach(F.least("left", "far"), n, F.col("least"), percent)
                              & (100 * n >= percent * F.col("least")) & (100 * F.col("most") >= percent * n))
                .select(F.col("comp").alias("ca"), F.col("big").alias("cb")).distinct())
    here = rows.filter(F.col("n") <= region).union(others.select(rows.columns))
    here = here.join(wide.select("id", *SKETCH), "id").withColumn(
        "salts", F.ceil(F.col("n") / SORTED_ROWS).cast("int"))
    # a very common shingle is dealt over several tasks
    x = here.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).alias("x")
    y = here.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("y")
    pairs = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.salt") == F.col("y.salt"))
                    & (F.col("x.comp") < F.col("y.comp"))
                    & _reach(F.least("x.left", "y.left"), F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
                    & _near("x", "y", percent))
             .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    return pairs, meetings


def _confirm_meetings(meetings: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that meet: every member of one against every member of the other.

    Sketch and full sets are compared inside the join, so only links come out
    of it. The smaller component is the side that is repeated per meeting.
    """
    size = members.groupBy("comp").agg(F.count("*").alias("k"))
    sized = (meetings.join(size.select(F.col("comp").alias("ca"), F.col("k").alias("ka")), "ca")
             .join(size.select(F.col("comp").alias("cb"), F.col("k").alias("kb")), "cb"))
    small = F.when(F.col("ka") <= F.col("kb"), F.col("ca")).otherwise(F.col("cb"))
    large = F.when(F.col("ka") <= F.col("kb"), F.col("cb")).otherwise(F.col("ca"))
    asked = sized.select(small.alias("comp"), large.alias("other")).distinct()
    full = members.join(sets, "id")
    x = full.join(asked, "comp").alias("x")
    y = full.join(asked.select(F.col("other").alias("comp")).distinct(), "comp", "left_semi").alias("y")
    shared = F.size(F.array_intersect(F.col("x.set"), F.col("y.set")))
    united = F.col("x.n_shingles") + F.col("y.n_shingles") - shared
    return (x.join(y, (F.col("x.other") == F.col("y.comp")) & _near("x", "y", percent)
                   & (100 * shared >= percent * united))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))


def near_components(docs: DataFrame, reps: DataFrame, width: int, percent: int, region: int = REGION,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component) of every representative that has a confirmed link.

    ``reps``: id, set_hash, signature columns and doc_id, a document that has the set (the id, if left out).
    """
    if "doc_id" not in reps.columns:
        reps = reps.withColumn("doc_id", F.col("id"))
    trees = materialize(_tree_rows(reps), "near-trees")
    stars = materialize(_star_links(trees, percent), "near-stars")
    # whoever shares a region may have to be confirmed: their sets are made once
    asked = materialize(reps.select("id", "doc_id", "set_hash").join(trees.select("id").distinct(), "id", "left_semi"),
                        "near-asked")
    sets = shingle_sets(keep_ids(docs, asked, id_col), width, id_col, text_col)
    sets = materialize(sets.join(asked, ["doc_id", "set_hash"]).dropDuplicates(["doc_id", "set_hash"])
                       .select("id", "set"), "near-sets")
    first = (stars.groupBy("a").agg(F.max(F.struct("central", (-F.col("b")).alias("neg"))).alias("h"))
             .select("a", (-F.col("h.neg")).alias("b")))
    links = materialize(confirm(sets, first, percent), "near-links")
    comp = materialize(components(links), "near-comp")

    def component(rows: DataFrame, col: str, out: str) -> DataFrame:
        known = comp.select(F.col("id").alias(col), F.col("component").alias("_c"))
        return rows.join(known, col, "left").withColumn(out, F.coalesce("_c", col)).drop("_c")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    # first what grows with the documents: other stars, neighbours in the sorted orders
    other = component(component(stars.select("a", "b"), "a", "ca"), "b", "cb").filter("ca <> cb")
    near = _neighbour_links(component(trees, "id", "comp"), percent)
    near = materialize(ordered(near.union(other.select("a", "b"))), "near-neighbours")
    if not near.isEmpty():
        links = materialize(links.union(confirm(sets, near, percent)), "near-links")
        comp = materialize(components(links), "near-comp")
    # then everything that is still open inside a region
    rows = component(trees, "id", "comp")
    pairs, wide = _open_pairs(rows, percent, region)
    wide = materialize(wide, "near-wide")
    meetings = None
    if not wide.isEmpty():
        among, meetings = _wide_pairs(wide, sets, percent, region)
        pairs, meetings = pairs.union(among), materialize(meetings, "near-meetings")
    pairs = materialize(ordered(pairs).join(near, ["a", "b"], "left_anti"), "near-pairs")
    more = None
    if not pairs.isEmpty():
        more = confirm(sets, pairs, percent)
    if meetings is not None and not meetings.isEmpty():
        met = _confirm_meetings(meetings, wide, sets, percent)
        more = met if more is None else more.union(met)
    return comp if more is None else components(links.union(more))


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, region: int = REGION,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents are linked when 100 * intersection >= percent * union of their
    sets of ``width``-word shingles; component_id is the smallest id reachable.
    """
    return (near_verdicts(docs, width, percent, region, id_col, text_col)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def near_verdicts(docs: DataFrame, width: int, percent: int, region: int = REGION,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``near_dedup`` with set_hash and ``group``, a number of the component (NULL: no set or id)."""
    signed = materialize(signatures(docs, width, id_col, text_col), "near-signed")
    known = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    groups = materialize(known.groupBy("set_hash", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), *[F.any_value(c).alias(c) for c in
                                           (*SKETCH, *[f"k{d}" for d in LEVELS])])
        .withColumn("id", F.monotonically_increasing_id()), "near-groups")
    comp = near_components(docs, groups, width, percent, region, id_col, text_col)
    own_ids = groups.select("id", "doc_id", "set_hash", "n_shingles")
    linked = materialize(own_ids.join(comp, "id"), "near-linked")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    member = (linked.join(least, "component").select("id", "component", "component_id"))
    member = (own_ids.join(member, "id", "left")
              .select("set_hash", "n_shingles", F.coalesce("component", "id").alias("group"),
                      F.coalesce("component_id", "doc_id").alias("component_id")))
    out = signed.select("doc_id", "n_shingles", "set_hash").join(member, ["set_hash", "n_shingles"], "left")
    named = F.col("doc_id").isNotNull()
    own = F.when(named, F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
                      "set_hash", F.when(named, F.col("group")).alias("group"))


def drop_near(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` without near copies: all columns of one row per component.

    Ids that occur once are joined back by id. Rows of an id that occurs
    several times are told apart by their sets, and of rows with the same id
    and set one stays. Rows without a word and rows with a NULL id all stay.
    """
    verdict = materialize(near_verdicts(docs, width, percent, id_col=id_col, text_col=text_col), "near-verdict")
    repeated = materialize(verdict.filter("doc_id IS NOT NULL").groupBy("doc_id").count()
                           .filter("count > 1").select("doc_id"), "near-repeated")
    if repeated.isEmpty():
        return keep_ids(docs, verdict.filter("kept"), id_col)
    once = keep_ids(docs, verdict.filter("kept").join(repeated, "doc_id", "left_anti"), id_col)
    # the row that stays of a component whose smallest id occurs several times
    chosen = (verdict.filter("kept AND group IS NOT NULL").join(repeated, "doc_id", "left_semi")
              .groupBy("group", "doc_id").agg(F.min("set_hash").alias("set_hash")).drop("group"))
    several = keep_ids(docs, repeated, id_col).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"),
        F.xxhash64(f"`{text_col}`").alias("_key"))
    hashed = signatures(several.select("_key", "_text"), width, "_key", "_text").select(
        F.col("doc_id").alias("_key"), "set_hash", "n_shingles").distinct()
    several = several.join(hashed, "_key")
    few = several.filter("n_shingles > 0").join(chosen, ["doc_id", "set_hash"], "left_semi").dropDuplicates(
        ["doc_id", "set_hash"])
    return once.unionByName(several.filter("n_shingles = 0").unionByName(few).select("_doc.*"))
