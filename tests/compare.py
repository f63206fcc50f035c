"""Run a registered query and its SQL twin on the same tables and compare the values."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents labels "
    "embeddings pages benchmark conversations"
).split()
DATA = Path(os.environ.get("TEST_DATA_DIR", "/root/testdata"))


def open_duckdb(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA / sf / (name + '.parquet')}'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v + 0.0:.9g}")
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((x is not None, str(x)) for x in r))


def compare(name, fn, sql, spark, con, sf):
    """None when equal, else a short description of the first difference."""
    df = fn(spark, str(DATA / sf))
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"{name}: columns {sorted(df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows != {len(want)}"
    for a, b in zip(_sorted_rows(df.columns, got), _sorted_rows(want_cols, want)):
        if a != b:
            return f"{name}: spark {str(a)[:700]} != sql {str(b)[:700]} (columns {sorted(want_cols)})"
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"{name}: types {type(x)} {type(y)} in {str(a)[:200]}"
    if not got:
        return f"{name}: no rows"
    return None
