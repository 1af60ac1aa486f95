"""Registered queries of the text operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (bpe, class_lm, exact_dedup, filter_audit, fingerprints, html_text, near_dedup,
                         packing, quality_classifier, quality_rules, resampling, sharding, toxicity)
from kestrel.llm.oracles import filter_audit_sql, resampling_sql
from kestrel.session import materialize
from kestrel.sources.tables import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_rules.quality(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "quality_prob"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read_table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier.score(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "source", "lang", "classifier_prob", "host_prob", "path_prob",
                      "quality_prob", F.col("quality_kept").alias("kept"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model)
            .select("doc_id", "p_toxic", "p_severe", "expected_severity", "grade", "toxic",
                    (~F.col("toxic")).alias("kept")))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(read_table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_packing": op4_packing,
    "op5_bpe": op5_bpe,
    "op6_sharding": op6_sharding,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_class_lm": op9_class_lm,
    "op10_html_extraction": op10_html_extraction,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op12_importance_resampling": resampling_sql(),
    "op13_filter_audit": filter_audit_sql(),
}
