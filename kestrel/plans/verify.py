"""Compare a Spark result with a DuckDB oracle result (tests and tools)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import DataFrame

from kestrel.sources.tables import TABLES


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, digits):.{digits}f}"
    if isinstance(v, Decimal):
        return f"{round(float(v), digits):.{digits}f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x, digits)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, digits) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    return str(v)


def spark_rows(df: DataFrame):
    cols = df.columns
    return cols, [tuple(r[c] for c in cols) for r in df.collect()]


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def canonical(cols, rows, digits: int = 6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_norm(r[i], digits) for i in order) for r in rows)
    return [cols[i] for i in order], out


def compare(df: DataFrame, con, sql: str, digits: int = 6) -> dict:
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    sc, sr = canonical(s_cols, s_rows, digits)
    dc, dr = canonical(d_cols, d_rows, digits)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "values_match": sr == dr}
    if sc != dc:
        res["spark_columns"], res["oracle_columns"] = sc, dc
    if sr != dr:
        s_set, d_set = set(sr), set(dr)
        res["only_spark"] = sorted(s_set - d_set)[:5]
        res["only_oracle"] = sorted(d_set - s_set)[:5]
    res["ok"] = res["columns_match"] and res["values_match"]
    return res
