"""Spark results against DuckDB's, regardless of order."""

import glob
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def duck(data: str = DATA):
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: "NULL" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def same(spark, function, sql: str, data: str = DATA) -> None:
    ours, theirs = plain(function(spark, data).toPandas()), plain(duck(data).execute(sql).fetchdf())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs)
    assert ours.equals(theirs), (ours[(ours != theirs).any(axis=1)].head(3), theirs[(ours != theirs).any(axis=1)].head(3))
