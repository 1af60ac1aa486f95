import numpy as np
import public_tokenizers
from helpers import DOCS, ODD, docs, smoke_rows
from kestrel.llm import packing as pk
from kestrel.llm import tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_pieces_are_the_documents(spark):
    rows = [(r[0], r[1]) for r in smoke_rows()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(5)
    pieces = pk.pack(df, PATH).collect()
    ids = dict(zip([d for d, _ in rows], library_ids([t for _, t in rows])))
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == np.array(ids[d], "<u4").tobytes()
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert all(p.doc_tokens == len(ids[d]) and len(p.ids) == 4 * p.length for p in own)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, own in by_seq.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        total = sum(p.length for p in own)
        assert total == pk.WINDOW or s == len(by_seq) - 1 and 0 < total <= pk.WINDOW


def test_sequences_put_windows_together(spark):
    pieces = pk.pack(docs(spark, ODD), PATH, window=64)
    stream = b"".join(bytes(r.ids) for r in pk.sequences(pieces).orderBy("sequence_id").collect())
    assert stream == b"".join(np.array(x, "<u4").tobytes() for x in library_ids(ODD))


def test_a_long_document_is_cut_once(spark):
    text = " ".join(f"w{i % 977}" for i in range(300_000))
    pieces = pk.pack(docs(spark, ["a", text, "b"]), PATH, window=16).orderBy("sequence_id", "offset").collect()
    want = library_ids(["a", text, "b"])
    assert b"".join(bytes(p.ids) for p in pieces) == b"".join(np.array(x, "<u4").tobytes() for x in want)
    assert len(pieces) == 2 + -(-sum(map(len, want)) // 16)


def test_long_chunks_stay_out_of_the_memo():
    encoder = tokens.ChunkEncoder(PATH, most=10)
    texts = ["x" * 5000, " ".join(f"w{i}" for i in range(50)), "é" * 40]
    for t, want in zip(texts, library_ids(texts)):
        assert encoder.encode(t.encode()) == np.array(want[:-1], "<u4").tobytes()
        kept = [*encoder.memo, *encoder.memo.old]
        assert len(kept) <= 20 and max(map(len, kept), default=0) <= tokens.LONGEST_KEPT
    encoder.memo.clear()
    assert not encoder.memo and not encoder.memo.old


def test_empty_table_null_id_and_clashing_columns(spark):
    assert pk.pack(docs(spark, ["x"]).limit(0), PATH).count() == 0
    df = spark.createDataFrame([(None, None, 3), (1, "a", 4), (1, "a", 4)], "doc_id long, text string, part int")
    got = sorted((str(r.doc_id), r.doc_tokens) for r in pk.pack(df, PATH).collect())
    assert got == [("1", 2), ("1", 2), ("None", 1)]
