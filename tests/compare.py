"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(row[c]) for c in names) for row in df.select(*names).collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, query: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(query)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in cur.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=repr)
