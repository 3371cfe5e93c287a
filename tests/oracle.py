"""Spark queries against their SQL in DuckDB."""

import os

import duckdb


def connect(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        p = f"{sf}/{f}"
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def canon(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (int, float)) or hasattr(v, "dtype") or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v)


def same(spark, fn, sql, sf, con):
    df = fn(spark, sf)
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns), (df.columns, rel.columns)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=repr)
    order = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(canon(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want), (len(got), len(want))
    for g, w in zip(got, want):
        assert g == w, (g, w)
