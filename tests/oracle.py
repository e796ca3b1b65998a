"""Local copy of the correctness gate: run a Spark query and its DuckDB SQL on
the same Parquet tables and compare row count, column names and an
order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, sql: str, con) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out = {"rows_spark": len(s_rows), "rows_sql": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["hash_match"] = (hashlib.sha1(repr(a).encode()).hexdigest()
                         == hashlib.sha1(repr(b).encode()).hexdigest())
    if not out["cols_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if not out["hash_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_sql"] = [r for r in b if r not in sa][:3]
    out["ok"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out
