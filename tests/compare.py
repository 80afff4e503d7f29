"""Running a statement in DuckDB and comparing whole results."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())
    return [names[i] for i in order], rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    return names, rows
