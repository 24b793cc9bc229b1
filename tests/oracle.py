"""Run a query on Spark and its SQL on DuckDB over the same files, and compare values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if value is None:
        return "NULL"
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return canonical([c[0] for c in cur.description], cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short account of the first differences."""
    names_a, rows_a = spark_rows(df)
    names_b, rows_b = duck_rows(con, sql)
    if names_a != names_b:
        return f"columns: only spark {sorted(set(names_a) - set(names_b))}, only sql {sorted(set(names_b) - set(names_a))}"
    if rows_a == rows_b:
        return None
    only_a, only_b = sorted(set(rows_a) - set(rows_b)), sorted(set(rows_b) - set(rows_a))
    lines = [f"rows {len(rows_a)} vs {len(rows_b)}; differing {len(only_a)} / {len(only_b)}; columns {names_a}"]
    lines += [f"spark {r}" for r in only_a[:2]] + [f"sql   {r}" for r in only_b[:2]]
    return "\n".join(lines)
