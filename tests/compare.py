"""Rows of a Spark query against its DuckDB SQL on the same tables."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def database(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return db


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def key(row):
    return tuple((x is None, str(type(x)) if x is None else "", f"{x:.3f}" if isinstance(x, float) else str(x)) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=key)


def differences(spark_df, db, sql) -> str:
    a_names, a = rows_of(spark_df.columns, spark_df.collect())
    got = db.sql(sql)
    b_names, b = rows_of(got.columns, got.fetchall())
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows; {a[:2]} {b[:2]}"
    for x, y in zip(a, b, strict=True):
        for n, p, q in zip(a_names, x, y, strict=True):
            if p != q and not (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=2e-6)):
                return f"{n}: {p!r} and {q!r} in {x} and {y}"
    return ""
