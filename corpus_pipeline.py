"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``; all
but the last return the rows of ``docs`` that stay, with the columns of
``docs``; the last returns the packed pieces. ``run`` writes the result of each
stage as Parquet and reads it again as the next one's ``docs``, so a lost
executor repeats part of one stage only.

Rows with NULL columns, repeated rows and empty tables get the results that the
operators' docstrings define; columns of ``docs`` with the names of operator
columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import exact_dedup, near_dedup, packing, quality_classifier, toxicity
from kestrel.llm.catalog import WORD_BPE
from kestrel.session import arrow_rows, materialize
from kestrel.sources.tables import read_table


def _whole(docs: DataFrame, *needed: str) -> DataFrame:
    """The rows as one struct ``_doc`` beside the columns an operator reads; a missing one is NULL."""
    have = {c.lower() for c in docs.columns}
    cols = [F.col(f"`{c}`").alias(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in needed]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *cols)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose posterior of good quality is below one half."""
    scored = quality_classifier.score(_whole(docs, "doc_id", "text", "source", "lang"),
                                      read_table(spark, sf_dir, "labels"))
    return scored.filter("quality_kept").select("_doc.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are toxic (grade 1 or more) more likely than not."""
    with arrow_rows(spark):
        model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(_whole(docs, "text"), model).filter(~F.col("toxic")).select("_doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    with arrow_rows(spark):
        return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the smallest id stays."""
    with arrow_rows(spark):
        return near_dedup.drop_near(docs, width=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    # executors still hold what the stages before took, so the memo is small here
    return packing.pack(docs, WORD_BPE, memo=100_000)


STAGES = [("quality_classifier", quality), ("toxicity", toxic), ("exact_dedup", exact),
          ("near_dedup", near), ("packing", pack)]

#: Classifiers, min-hash links and a tokenizer are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces of the documents that stay."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
