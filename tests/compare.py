"""Rows of a query against those of its SQL."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rounded(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(rounded, v)) if isinstance(v, (list, tuple)) else v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(rounded(r[c]) for c in cols) for r in df.collect()), key=repr)


def duckdb_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    return cols, sorted((tuple(rounded(r[i]) for i in at) for r in rel.fetchall()), key=repr)
