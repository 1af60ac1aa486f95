import zlib
from collections import Counter

from helpers import ODD, docs, smoke_rows
from kestrel.llm import sharding as sh
from pyspark.sql import functions as F


def test_fisher_yates_is_a_seeded_permutation():
    a, b = sh.fisher_yates(500, 1), sh.fisher_yates(500, 1)
    assert (a == b).all() and sorted(a) == list(range(500)) and list(a) != list(range(500))
    assert (sh.fisher_yates(500, 2) != a).any() and len(sh.fisher_yates(0, 1)) == 0
    first = Counter(int(sh.fisher_yates(4, s)[0]) for s in range(4000))
    assert all(900 < n < 1100 for n in first.values())


def test_every_record_has_one_place(spark):
    texts = [r[1] for r in smoke_rows()] + ODD
    df = docs(spark, texts)
    out = sh.shard(df, shards=7, bucket_bytes=60_000)
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.text) == (len(raw) + 16, zlib.crc32(raw), texts[r.doc_id])
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    again = {(r.doc_id, r.shard, r.slot) for r in sh.shard(df.repartition(5), 7, bucket_bytes=60_000).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_a_row_repeated_very_often_is_spread(spark):
    rows = [(None, "x" * 84)] * 4000 + [(7, "y" * 84)] * 2000 + [(i, f"text {i}") for i in range(100, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    sizes = {r.bucket: r.b for r in sh.scatter(df, bucket_bytes=20_000).groupBy("bucket").agg(F.sum("size").alias("b")).collect()}
    assert sum(sizes.values()) == sum(len(t) + 16 for _, t in rows) and max(sizes.values()) <= 5 * 20_000
    out = sh.shard(df, shards=40, bucket_bytes=20_000).select("doc_id", "shard", "slot").collect()
    again = sh.shard(df.repartition(4), shards=40, bucket_bytes=20_000).select("doc_id", "shard", "slot").collect()
    assert sorted((r.slot, r.shard) for r in out) == [(i // 40, i % 40) for i in range(len(rows))]
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_written_shards_and_edge_cases(spark, tmp_path):
    df = spark.createDataFrame([(None, None, "p"), (1, "a", "q"), (1, "a", "q"), (1, "b", "r")],
                               "doc_id long, text string, Slot string")
    out = sh.shard(df, shards=2)
    assert sorted(out.columns) == ["doc_id", "shard", "size", "slot", "text", "text_crc32"]
    sh.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert Counter(r.shard for r in back.collect()) == {0: 2, 1: 2}
    assert sh.shard(df.limit(0)).count() == 0
