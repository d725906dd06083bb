"""Side-by-side check of a Spark query against its DuckDB oracle text.

Both results are brought to plain Python rows with columns sorted by name,
doubles rounded, arrays as tuples; then the two multisets are compared.
Used by the tests and by ``tools/oracle_check.py``.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame

from sentispark.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):  # Decimal
        return round(float(v), digits) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x), digits) for x in v.toArray())
    return v


def spark_rows(df: DataFrame, digits: int = 6):
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, [tuple(_norm(v, digits) for v in r) for r in rows]


def duck_rows(con, sql: str, digits: int = 6):
    rel = con.sql(sql)
    names = list(rel.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return ([names[i] for i in order],
            [tuple(_norm(r[i], digits) for i in order) for r in rows])


def compare(df: DataFrame, con, sql: str, digits: int = 6) -> dict:
    s_cols, s_rows = spark_rows(df, digits)
    d_cols, d_rows = duck_rows(con, sql, digits)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "spark_cols": s_cols, "oracle_cols": d_cols}
    sc, dc = Counter(map(repr, s_rows)), Counter(map(repr, d_rows))
    out["values_match"] = out["columns_match"] and sc == dc
    if not out["values_match"]:
        out["only_spark"] = list((sc - dc).elements())[:3]
        out["only_oracle"] = list((dc - sc).elements())[:3]
    return out
