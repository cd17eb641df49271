"""Spark result vs DuckDB oracle: same rows, columns and values.

Columns are compared by name; rows as an order-insensitive multiset. Floats
must agree exactly after rounding to ``digits`` decimals (default 9).
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, digits)
        return repr(r + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "as_tuple"):  # Decimal
        return repr(round(float(v), digits))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, digits) for x in v) + "]"
    return str(v)


def rows_of_spark(df):
    cols = df.columns
    return cols, [tuple(r[c] for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def compare(spark_df, con, sql, digits: int = 9):
    """Return (ok, message)."""
    sc, sr = rows_of_spark(spark_df)
    dc, dr = rows_of_duck(con, sql)
    if sorted(sc) != sorted(dc):
        return False, f"columns differ: spark-only {sorted(set(sc)-set(dc))} oracle-only {sorted(set(dc)-set(sc))}"
    order = sorted(sc)
    si = [sc.index(c) for c in order]
    di = [dc.index(c) for c in order]
    a = Counter(tuple(_norm(r[i], digits) for i in si) for r in sr)
    b = Counter(tuple(_norm(r[i], digits) for i in di) for r in dr)
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} oracle={len(dr)}"
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        return False, f"values differ ({sum((a-b).values())} rows); cols={order}\n spark: {only_a}\n oracle: {only_b}"
    return True, f"{len(sr)} rows"
