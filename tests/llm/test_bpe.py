import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCS, ODD, smoke_rows
from kestrel.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    return bpe.BytePairCoder(PATH)


def _random_texts():
    rnd = random.Random(1)
    alphabet = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070), 0x300, 0x3a3, 0x4e2d, 0x1F600,
                                 0x3000, 0x1680, 0x378, 0xfeff]]
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    out += ["a" * 4000, "ab" * 3000 + " " + "é" * 2000, "  a  b  ", "\n\n x\n", "<|endoftext|>" * 3]
    return out


def test_ids_and_text_equal_the_library(coder, library):
    for text in [r[1] for r in smoke_rows()] + [t or "" for t in ODD] + _random_texts():
        want = library.encode(text, add_special_tokens=False).ids
        ids = coder.encode(text.encode())
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert coder.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_forced_boundaries_lie_in_no_token(coder):
    raw = "thequickbrownfox12é日本".encode() * 3
    parts = coder.cuts(raw)
    assert b"".join(parts) == raw and len(parts) > 1
    pairs = {a[-1:] + b[:1] for a, b in zip(parts, parts[1:])}
    assert not any(p in t for p in pairs for t in coder.token_bytes.values())


def test_long_and_short_merges_agree(coder):
    rnd = random.Random(4)
    for _ in range(200):
        ids = [coder.byte_ids[b] for b in bytes(rnd.choice(b"etaoin shrdlu") for _ in range(60))]
        assert coder._merge(list(ids)) == coder._merge_long(list(ids))


def test_spark_round_trip(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD * 2)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert r.decoded == text and r.n_tokens == len(bytes(r.ids)) // 4
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert hashlib.sha256(r.ids).digest() == hashlib.sha256(want).digest()
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_unknown_ids_decode_to_nothing(coder):
    assert coder.decode(np.array([999_999], "<u4").tobytes()) == ""
    assert coder.decode(b"") == ""
