"""Byte-pair encoding and decoding with forced boundaries.

The vocabulary's pattern splits a text into pieces. Inside a piece, two bytes
that stand next to each other in no vocabulary token can never share a token,
so there is a certain cut between them. The fragments between cuts are merged
independently -- and memoised -- and their ids concatenated, which gives the
ids of the whole text whatever its length.

Defined results: NULL and empty texts have no ids and decode to the empty
text; strings of special tokens become their ids, as the tokenizers library
does by default; ids outside the vocabulary decode to nothing; bytes that are
not UTF-8 decode to replacement characters. Repeated rows are encoded alike;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kestrel.llm.common import Memo, id_and_raw, only
from kestrel.llm.tokens import byte_chars

#: Fixed value: how byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters beyond these ranges may be classed differently by another Unicode
#: version; texts that hold any are split by the library's own pre-tokenizer.
_SETTLED = re.compile("[\x00-ɏͰ-ϿЀ-ҁ‐-‧‰-⁞"
                      "ぁ-ゖァ-ヺ一-龥가-힣]*")
#: Texts of ASCII and Latin-1 letters alone need no Unicode tables: the same pattern with plain classes.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^A-Za-zÀ-ÖØ-öø-ÿ0-9 \t-\r]+"
    r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: Longer pieces and fragments are not memoised.
MEMO_BYTES = 48
_LONG = 40


class BytePairCoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, most: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b])
                       for rank, (a, b) in enumerate(pairs)}
        self.byte_ids = [vocab[c] for c in byte_chars()]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes.update({i: s.encode() for s, i in self.special.items()})
        #: inside[256 * a + b]: some token holds byte a right before byte b
        self.inside = np.zeros(65536, bool)
        for t in self.token_bytes.values():
            if len(t) > 1:
                b = np.frombuffer(t, np.uint8).astype(np.int64)
                self.inside[b[:-1] * 256 + b[1:]] = True
        self.inside_list = self.inside.tolist()
        self.pattern = regex.compile(PATTERN)
        self.cut_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.pieces = Memo(self._piece, most)
        self.fragments = Memo(self._fragment, most)
        self._library = None

    def cuts(self, raw: bytes) -> list[bytes]:
        """The fragments of ``raw`` between forced boundaries."""
        if len(raw) <= MEMO_BYTES:
            inside = self.inside_list
            at = [i for i in range(1, len(raw)) if not inside[raw[i - 1] << 8 | raw[i]]]
            return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])] if at else [raw]
        b = np.frombuffer(raw, np.uint8).astype(np.int64)
        at = (np.flatnonzero(~self.inside[b[:-1] * 256 + b[1:]]) + 1).tolist()
        return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])]

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.fragments[f] if len(f) <= MEMO_BYTES else self._fragment(f)
                         for f in self.cuts(piece.encode())])

    def _fragment(self, raw: bytes) -> bytes:
        ids = [self.byte_ids[b] for b in raw]
        ids = self._merge_long(ids) if len(ids) > _LONG else self._merge(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge(self, ids: list[int]) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none applies."""
        merges = self.merges
        while len(ids) > 1:
            best, at = None, 0
            for i in range(len(ids) - 1):
                m = merges.get((ids[i], ids[i + 1]))
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for long fragments."""
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heap = [(rank, i, new, p) for rank, new, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, (a, b) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if left >= 0 and right < n:
                    m = merges.get((ids[left], ids[right]))
                    if m:
                        heapq.heappush(heap, (m[0], left, m[1], (ids[left], ids[right])))
        return [x for x in ids if x >= 0]

    def _split(self, text: str) -> list[str]:
        if _LATIN.fullmatch(text):
            return _LATIN_PIECES.findall(text)
        if _SETTLED.fullmatch(text):
            return self.pattern.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        # the library's offsets are those of the text it was given
        return [text[i:j] for _, (i, j) in self._library.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> bytes:
        memo, piece = self.pieces, self._piece
        return b"".join([memo[p] if len(p) <= MEMO_BYTES else piece(p) for p in self._split(text)])

    def encode(self, raw: bytes) -> bytes:
        """Ids of a text's UTF-8 bytes, as little-endian unsigned 32-bit bytes."""
        text = raw.decode("utf-8", "replace")
        if self.cut_special is None or not self.cut_special.search(text):
            return self._ordinary(text)
        out, at = [], 0
        for m in self.cut_special.finditer(text):
            out += [self._ordinary(text[at:m.start()]),
                    np.array([self.special[m.group()]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._ordinary(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids, special tokens included."""
        get = self.token_bytes.get
        return b"".join([get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_CODERS: dict[str, BytePairCoder] = {}


def coder(path: str) -> BytePairCoder:
    """The coder of this Python worker, kept between tasks."""
    if path not in _CODERS:
        _CODERS[path] = BytePairCoder(path)
    only(_CODERS[path].pieces, _CODERS[path].fragments)
    return _CODERS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every whole text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                ids = [c.encode(r) for r in b.column("raw").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return id_and_raw(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded (the text) of the rows of ``encode``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for b in batches:
            texts = [c.decode(x) if x else "" for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_tokens"), b.column("ids"), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return (encoded.select("doc_id", "n_tokens", "ids")
            .mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string"))
