"""Compare queries with their SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at if os.path.isfile(at) else at + '/*.parquet'}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else float(repr(round(value, 9)))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if they agree, else what differs."""
    got = query(spark, sf_dir)
    con = connect(sf_dir)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} and {sorted(names)}"
    order = sorted(names)
    rows = want.fetchall()
    a = Counter(tuple(plain(r[c]) for c in order) for r in got.collect())
    b = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in rows)
    if a == b:
        return ""
    return f"{sum(a.values())} and {sum(b.values())} rows; only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}"
