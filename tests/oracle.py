"""Runs a registered query and its SQL over the same tables and compares the rows."""

import math
import os

import pandas as pd

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6) + 0.0
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(value(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


def same(spark, query, sql, sf="sf0.001"):
    import duckdb

    folder = os.path.join(DATA, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    ours, theirs = query(spark, folder).toPandas(), con.execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
