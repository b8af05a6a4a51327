"""Order-insensitive comparison of a query with its SQL."""

import glob
import math
import os

import duckdb
import pandas as pd


def views(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if hasattr(x, "tolist") and not isinstance(x, (str, bytes)):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    if isinstance(x, bool) or isinstance(x, str):
        return str(x)
    return f"{float(x) + 0.0:.9g}"


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return list(df.columns), sorted(str([plain(v) for v in r]) for r in df.itertuples(index=False))


def same(spark_df, sql, connection):
    a, b = rows(spark_df.toPandas()), rows(connection.sql(sql).df())
    assert a[0] == b[0]
    assert a[1] == b[1]
