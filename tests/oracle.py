"""Run a named query in Spark and its SQL in DuckDB, and compare rows as unordered sets."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(query, spark, sf_dir: str, con) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(query.oracle())
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} != {b}"
    return None
