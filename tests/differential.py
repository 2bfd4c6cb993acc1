"""Runs registered queries beside their SQL in DuckDB and compares all rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "normalize") and hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if all rows agree."""
    df = query(spark, sf_dir)
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} and {sorted(rel.columns)}"
    mine = sorted((tuple(_plain(r[c]) for c in names) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in names]
    theirs = sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if mine == theirs:
        return ""
    pairs = [(a, b) for a, b in zip(mine, theirs, strict=False) if a != b][:2]
    return f"{len(mine)} and {len(theirs)} rows; {pairs}"
