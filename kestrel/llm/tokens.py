"""Ids of whole texts by a public tokenizer whose chunks between white space are independent.

``word_bpe`` vocabularies drop white space and never let a token cross it, so
the ids of a text are the ids of its chunks one after the other. Chunks are
memoised (bounded), which is what makes whole corpora affordable.
"""

from __future__ import annotations

import json
import re

import numpy as np

from kestrel.llm.common import Memo, only

# Chunks of these characters need no Unicode tables: lower-casing and the
# split pattern are decided by the ranges below. Others go to the library.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


#: A longer chunk is encoded each time, so the memo's entries are small and their number bounds its bytes.
LONGEST_KEPT = 64
#: Chunks in each of a memo's two generations; about 200 bytes a chunk in every Python worker.
MEMO_ENTRIES = 250_000


class ChunkMemo(Memo):
    """A memo of two generations: when the young one is full it becomes the old one; what is asked for again returns."""

    def __init__(self, compute, most: int):
        super().__init__(compute, most)
        self.old: dict = {}

    def clear(self) -> None:
        super().clear()
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONGEST_KEPT:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            super().clear()
        self[key] = value
        return value


class ChunkEncoder:
    """``encode(raw)``: ids of a text's UTF-8 bytes, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, most: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        self.special = [t["content"].encode() for t in added]
        self.shown = {i: c for i, c in enumerate(byte_chars())}
        self.memo = ChunkMemo(self._chunk, most)

    def _library(self, raw: bytes) -> bytes:
        ids = self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not _PLAIN.fullmatch(text):
            return self._library(chunk)
        ids = [t.id for piece in _PIECES.findall(text.lower())
               for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, raw: bytes) -> bytes:
        if any(s in raw for s in self.special):  # special tokens are cut before anything else
            return self._library(raw)
        return b"".join(map(self.memo.__getitem__, raw.split()))


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def chunk_encoder(path: str, most: int = MEMO_ENTRIES) -> ChunkEncoder:
    """The encoder of this Python worker; it is built once and keeps its memo between tasks."""
    if (path, most) not in _ENCODERS:
        _ENCODERS[path, most] = ChunkEncoder(path, most)
    only(_ENCODERS[path, most].memo)
    return _ENCODERS[path, most]
