"""A Spark result and DuckDB's, as lists of rows that can be compared."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def one(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    v = v.tolist() if hasattr(v, "tolist") else v
    if isinstance(v, float):
        return None if v != v else int(v) if v == int(v) else v
    return v if isinstance(v, (bool, int)) else str(v)


def rows(frame):
    return sorted(repr(tuple(map(one, r))) for r in frame[sorted(frame.columns)].itertuples(index=False))


def same(df, con, sql):
    spark, duck = df.toPandas(), con.execute(sql).df()
    assert sorted(spark.columns) == sorted(duck.columns)
    assert rows(spark) == rows(duck)
