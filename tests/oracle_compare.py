"""Run a registered query in Spark and its SQL in DuckDB; compare results.

The comparison mirrors the driver's: same row count, same column names,
and equal multisets of rows (columns sorted by name, values normalised)."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows), [cols[i] for i in order]


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    a, ac = rows_of(s_cols, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    h = lambda x: hashlib.sha1(repr(x).encode()).hexdigest()[:12]
    return {"spark_rows": len(a), "oracle_rows": len(b), "cols_match": ac == bc,
            "spark_cols": ac, "oracle_cols": bc, "values_match": a == b, "hash": (h(a), h(b)),
            "diff": (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])}
