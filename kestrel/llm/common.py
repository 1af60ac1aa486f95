"""Small helpers the text operators share.

Words follow one rule everywhere: maximal runs of bytes other than space and
``\\t \\n \\v \\f \\r``. ``bytes.split()`` without arguments splits at exactly
that set, and ``bytes.lower()`` changes A-Z only, so texts are handled as
their UTF-8 bytes and never decoded where that is not needed.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.joins import broadcast_if_bounded
from kestrel.session import materialize

#: The same rule for SQL functions (a Java regular expression class).
SPACE_CLASS = r"[\x20\x09-\x0D]"


def raw_text(text_col: str) -> Column:
    """UTF-8 bytes of a text column; NULL counts as empty."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")


def id_and_raw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text bytes: other columns are pruned from the scan."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       raw_text(text_col).alias("raw"))


#: Ids (a long each) that a semi-join may broadcast after counting them; beyond it texts are shuffled.
MOST_BROADCAST_IDS = 1_000_000


def keep_ids(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``kept`` (column ``doc_id``); a NULL id matches a NULL id."""
    ids = materialize(kept.select(F.col("doc_id").alias("_kept_id")).distinct(), "ids")
    return docs.join(broadcast_if_bounded(ids, MOST_BROADCAST_IDS),
                     F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")


def free_columns(df: DataFrame, taken: tuple[str, ...]) -> list[str]:
    """Columns of ``df`` whose names do not clash (ignoring case) with ``taken``."""
    low = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in low]


class Memo(dict):
    """A bounded memo of ``compute(key)``; it starts afresh when it is full."""

    alive: weakref.WeakSet = weakref.WeakSet()
    __hash__ = object.__hash__
    __eq__ = object.__eq__

    def __init__(self, compute, most: int = 500_000):
        super().__init__()
        self.compute, self.most = compute, most
        Memo.alive.add(self)

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def only(*memos: Memo) -> None:
    """Empties all other memos of this Python worker, which may have served other operators before."""
    keep = {id(m) for m in memos}
    for m in list(Memo.alive):
        if id(m) not in keep:
            m.clear()
