"""Sinks. Every write is idempotent per run parameter, so a retried job
(lost executor, re-run of a day) replaces its own output instead of
duplicating it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """CSV with a header (one folder of part files)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def write_quarantine(rejects: DataFrame, base: str, day: str) -> str:
    """Rejected rows of one day, with their reason, under ``{base}/{day}``."""
    return write_csv(rejects, f"{base.rstrip('/')}/{day}", sep=";")


def write_partitioned_parquet(df: DataFrame, path: str,
                              partition_by: Sequence[str] = ("day",)) -> str:
    """Parquet partitioned by ``partition_by`` with dynamic partition overwrite:
    only the partitions present in ``df`` are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path
