"""Run a query on Spark and its SQL on DuckDB and compare them as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str:
    """Empty when both sides agree."""
    theirs = con.execute(sql)
    their_columns = [d[0] for d in theirs.description]
    if sorted(spark_df.columns) != sorted(their_columns):
        return f"columns differ: {spark_df.columns} / {their_columns}"
    expected = rows_of(their_columns, theirs.fetchall())
    found = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if found == expected:
        return ""
    extra, missing = found - expected, expected - found
    return f"{sum(found.values())} / {sum(expected.values())} rows; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
