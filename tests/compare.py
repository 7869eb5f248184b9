"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}")
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if a != b:
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems
