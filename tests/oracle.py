"""Comparison of a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import os

import duckdb

TESTDATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir: str, fn, sql: str) -> tuple[int, str]:
    """Row count and '' if equal, else what differs."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    cursor = con.execute(sql)
    expected_kinds = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(expected_kinds) != names:
        return len(rows), f"columns {names} != {sorted(expected_kinds)}"
    wrong = {n: (kinds[n], expected_kinds[n]) for n in names
             if _KINDS.get(kinds[n]) != expected_kinds[n]}
    if wrong:
        return len(rows), f"types {wrong}"
    order = [list(expected_kinds).index(n) for n in names]
    key = lambda row: tuple((v is not None, v) for v in row)
    expected = sorted((tuple(r[i] for i in order) for r in rows), key=key)
    actual = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=key)
    if len(actual) != len(expected):
        return len(actual), f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return len(actual), f"{a} != {e}"
    return len(actual), ""
