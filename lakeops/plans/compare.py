"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Used by the tests and by ``scripts/check_oracle.py``; it mirrors the driver's
gate: same column names, same row count, same multiset of rows.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, _dec.Decimal):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def duck_connect(sf_dir: str):
    import duckdb

    from lakeops.sources.driver import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> dict:
    """Return a dict with match flags and a few differing rows."""
    s_cols = list(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_raw = res.fetchall()
    out = {"spark_cols": s_cols, "oracle_cols": d_cols, "spark_rows": len(s_rows), "oracle_rows": len(d_raw)}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, reason="columns differ")
        return out
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_raw]
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    if a == b:
        out.update(ok=True)
        return out
    sa, sb = set(a), set(b)
    out.update(ok=False, reason="values differ", only_spark=list(sa - sb)[:5], only_oracle=list(sb - sa)[:5])
    return out
