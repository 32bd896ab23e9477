"""Run a registered query in Spark and its SQL twin in DuckDB and compare all rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str:
    """Empty when both agree, else what differs."""
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours == theirs:
        return "" if ours else "EMPTY"
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"rows {len(ours)} != {len(theirs)}; ours {str(only_ours)[:600]}; theirs {str(only_theirs)[:600]}"
