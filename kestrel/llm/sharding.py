"""Sharding by a two-pass external shuffle.

Pass 1 scatters whole records into memory-sized buckets by a seeded hash of id
and checksum. Equal rows that would overfill a bucket are numbered and scattered
in portions, so one row repeated any number of times never meets in one bucket.
Pass 2 loads one bucket at a time, puts it in a fixed order, applies a seeded
Fisher-Yates shuffle and writes it. Buckets one after the other are a random
order of the corpus; prefix sums over the bucket sizes number the records, and
number ``p`` goes to shard ``p mod shards``, slot ``p div shards`` -- so shard
row counts differ by one at most and slots have no gaps (law ``rows``).

Defined results: NULL text has size 16 and the checksum of the empty text; a
NULL id hashes like any value; repeated rows are records of their own, and
which of them takes which of their places is open (they tie); a very long text
is one record in one bucket. The
order depends only on seed, ids and texts, so a task that runs again gives
the same records the same places. Input columns whose names clash with the
output columns are replaced. An empty table gives no records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import free_columns, raw_text
from kestrel.operators.joins import broadcast_if_bounded
from kestrel.session import materialize

SHARDS = 40
SEED = 20240601
BUCKET_BYTES = 24 << 20
RECORD_BYTES = 16

_OWN = ("size", "text_crc32", "bucket", "pos", "shard", "slot")


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A seeded permutation of range(n): each position swaps with one at or before it."""
    rng = np.random.Generator(np.random.PCG64(seed))
    order = list(range(n))
    picks = rng.random(n)
    for i in range(n - 1, 0, -1):
        j = int(picks[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def scatter(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Records with size, text_crc32 and bucket; the number of buckets follows the total size."""
    raw = raw_text(text_col)
    one = F.col(f"`{id_col}`")
    rows = docs.select(*[F.col(f"`{c}`") for c in free_columns(docs, _OWN)],
                       (F.octet_length(raw) + RECORD_BYTES).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    keys = materialize(rows.groupBy(one.alias("_id"), F.col("text_crc32").alias("_crc")).agg(
        F.sum("size").alias("_size"), F.count("*").alias("_n")), "shard-keys")
    total = keys.agg(F.sum("_size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # at most four of these keys for each bucket
    portion = max(1, bucket_bytes // 4)
    hot = materialize(keys.filter((F.col("_size") > portion) & (F.col("_n") > 1)).select(
        "_id", "_crc", F.greatest(F.lit(1), F.expr(f"_n * {portion} div _size")).alias("_per")), "shard-hot")

    def placed(part: DataFrame, *salt: str) -> DataFrame:
        mixed = F.xxhash64(F.lit(seed), one, F.col("text_crc32"), *salt)
        return part.withColumn("bucket", F.pmod(mixed, F.lit(buckets)).cast("int"))

    if hot.isEmpty():
        return placed(rows)
    hot = broadcast_if_bounded(hot)
    same = one.eqNullSafe(F.col("_id")) & (F.col("text_crc32") == F.col("_crc"))
    equal = materialize(rows.join(hot, same).withColumn("_at", F.monotonically_increasing_id()), "shard-equal")
    equal = equal.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("_id", "_crc").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (equal.groupBy("_id", "_crc", "_part").agg(F.count("*").alias("_k"))
             .select("_id", "_crc", "_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base")))
    there = Window.partitionBy("_id", "_crc", "_part").orderBy("_at")
    numbered = equal.withColumn("_row", F.row_number().over(there)).alias("e").join(
        bases.alias("b"), F.col("e._id").eqNullSafe(F.col("b._id")) & (F.col("e._crc") == F.col("b._crc"))
        & (F.col("e._part") == F.col("b._part")))
    spread = numbered.select("e.*", ((F.col("_base") + F.col("_row") - 1) / F.col("_per")).cast("long").alias("_salt"))
    return (placed(rows.join(hot, same, "left_anti"))
            .unionByName(placed(spread, "_salt").select(*rows.columns, "bucket")))


def shuffle_buckets(scattered: DataFrame, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """Each bucket in a fixed order, then Fisher-Yates; ``pos`` is a record's place in its bucket."""
    schema = scattered.withColumn("pos", F.lit(0).cast("long")).schema

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        names = [id_col, "text_crc32", *[f.name for f in table.schema
                                         if pa.types.is_integer(f.type) or pa.types.is_string(f.type)
                                         or pa.types.is_large_string(f.type)]]
        table = table.sort_by([(n, "ascending") for n in dict.fromkeys(names)])
        table = table.take(pa.array(fisher_yates(table.num_rows, seed * 1_000_003 + bucket)))
        return table.append_column("pos", pa.array(np.arange(table.num_rows, dtype=np.int64)))

    return scattered.groupBy("bucket").applyInArrow(run, schema)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """All records, all columns, with size, text_crc32, shard and slot."""
    stored = materialize(shuffle_buckets(scatter(docs, seed, bucket_bytes, id_col, text_col),
                                         seed, id_col), "shard-buckets")
    sizes = stored.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # one row per bucket; beyond the bound the join shuffles
    placed = stored.join(broadcast_if_bounded(bases), "bucket").withColumn("p", F.col("base") + F.col("pos"))
    return (placed.withColumns({"shard": F.pmod("p", F.lit(shards)).cast("int"),
                                "slot": F.expr(f"p div {shards}")})
            .drop("bucket", "pos", "base", "p"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, records in slot order inside each file."""
    (sharded.repartition("shard").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
