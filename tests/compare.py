"""Rows of a Spark query against rows of DuckDB SQL, in any order."""

import math

import duckdb

from tests.conftest import DATA, TABLES


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, int | str | bool) else float(v) if hasattr(v, "as_tuple") else v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in values), key=str)


def same(spark, query, sql):
    df = query(spark, DATA)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
