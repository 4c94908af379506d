"""Runs a query and its SQL and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} {sorted(names)}"
    if got != want:
        a, b = set(got), set(want)
        odd = [x for x in got if x not in b][:3], [x for x in want if x not in a][:3]
        return f"{len(got)} rows, {len(want)} wanted; only got {odd[0]}; only wanted {odd[1]}"
    return ""
