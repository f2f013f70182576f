"""Compare a Spark result with what DuckDB gives for the same tables."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def kinds(columns, rows):
    return {c: sorted({type(r[i]).__name__ for r in rows if r[i] is not None}) for i, c in enumerate(columns)}


def differences(spark_df, con, sql: str) -> list[str]:
    found = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    out = []
    if sorted(spark_df.columns) != sorted(names):
        return [f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"]
    a, b = kinds(spark_df.columns, found), kinds(names, wanted)
    out += [f"{c}: type {a[c]} instead of {b[c]}" for c in a if a[c] and b[c] and a[c] != b[c]]
    if len(found) != len(wanted):
        out.append(f"{len(found)} rows instead of {len(wanted)}")
    left, right = canonical(spark_df.columns, found), canonical(names, wanted)
    if left != right:
        lr, rr = set(map(repr, left)), set(map(repr, right))
        out.append(f"values differ; only Spark: {[x for x in left if repr(x) not in rr][:3]}; only DuckDB: {[x for x in right if repr(x) not in lr][:3]}")
    return out
