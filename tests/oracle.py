"""Compare a query with its SQL twin on the same Parquet tables."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, list | tuple):
        return repr([plain(x) for x in v])
    return repr(v)


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(str([plain(r[i]) for i in at]) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def compare(spark, sf_dir, build, sql):
    df = build(spark, sf_dir)
    con = connect(sf_dir)
    got = con.sql(sql)
    columns = list(got.columns)
    assert sorted(df.columns) == sorted(columns)
    mine, theirs = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(columns, got.fetchall())
    assert mine == theirs
