"""Runs a query and its SQL side by side, as sorted rows with floats rounded."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.9g}")
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(x) for x in r) for r in df.select(*(f"`{c}`" for c in cols)).collect()), key=repr)


def duck_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    con.execute("SET TimeZone = 'UTC'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def same(df, sql: str, sf_dir: str) -> None:
    left, right = spark_rows(df), duck_rows(sql, sf_dir)
    assert left[0] == right[0], (left[0], right[0])
    assert len(left[1]) == len(right[1]), (len(left[1]), len(right[1]))
    for a, b in zip(left[1], right[1]):
        assert a == b, (a, b)
