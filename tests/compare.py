"""Order-insensitive comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, integer/float kinds, row counts and values agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_cols, want = _sorted_rows(names, cursor.fetchall())
    got_cols, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != got_cols:
        return [f"columns {got_cols} != {want_cols}"]
    if len(want) != len(got):
        return [f"rows {len(got)} != {len(want)}"]
    bad = [
        f"{g} != {w}"
        for g, w in zip(got, want)
        if g != w or any(type(a) is not type(b) for a, b in zip(g, w))
    ]
    return [f"{len(bad)} of {len(got)} rows differ", *bad[:3]] if bad else []
