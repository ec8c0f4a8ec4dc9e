"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int,)):
        return ("n", decimal.Decimal(v))
    if isinstance(v, decimal.Decimal):
        return ("n", v.normalize() if v != 0 else decimal.Decimal(0))
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", float(f"{v:.10g}"))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    return ("s", str(v))


def normalize(columns, rows, exact=False):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = repr if exact else _norm
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql, exact=False):
    """Problems found comparing the Spark rows with the DuckDB rows, order
    insensitive.  ``exact`` compares Python ``repr`` of every value (types,
    decimal scales and float bits included) instead of normalised values."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = normalize(s_cols, s_rows, exact)
    dc, dr = normalize(d_cols, d_rows, exact)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark-only {sorted(set(sc) - set(dc))}, duck-only {sorted(set(dc) - set(sc))}")
        return problems
    if len(sr) != len(dr):
        problems.append(f"row counts differ: spark {len(sr)} duck {len(dr)}")
    if sr != dr:
        ss, ds = set(sr), set(dr)
        only_s = [r for r in sr if r not in ds][:3]
        only_d = [r for r in dr if r not in ss][:3]
        problems.append(f"values differ; spark-only sample {only_s}; duck-only sample {only_d}")
    return problems
