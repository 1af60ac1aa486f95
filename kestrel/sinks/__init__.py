from kestrel.sinks.files import write_csv, write_partitioned_parquet, write_quarantine

__all__ = ["write_csv", "write_partitioned_parquet", "write_quarantine"]
