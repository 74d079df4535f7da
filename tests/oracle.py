"""Compares a query with its DuckDB SQL by values, whatever the order of rows and columns."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def text(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "NULL" if v is None else str(v)


def same(df, con, sql):
    cols = sorted(df.columns)
    got = sorted(tuple(map(text, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(text(r[i]) for i in at) for r in rel.fetchall())
    assert got == want
