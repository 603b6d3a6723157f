"""Run a query in Spark and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())
