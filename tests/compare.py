"""Run a query and its SQL side by side and compare them value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(sorted((str(k), plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is not None, type(v).__name__, v) if v is not None else (False, "", "") for v in row)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


def difference(spark, con, fn, sql, folder) -> str | None:
    """None when both agree, otherwise what differs first."""
    df = fn(spark, folder)
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for field in df.schema.fields:
        mine, theirs = field.dataType.simpleString(), types[field.name].upper()
        pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        if mine in pairs and pairs[mine] != theirs:
            return f"type of {field.name}: {mine} / {theirs}"
    a = as_rows(df.columns, [tuple(r) for r in got])
    b = as_rows(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return None if not bad else f"{len(bad)} of {len(a)} rows differ, first {bad[0]}"
