"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import os

SMALL = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(plain(r[n]) for n in order) for r in rows), key=repr)


def compare(spark, query, sql, folder=SMALL):
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    df = query(spark, folder)
    got = c.execute(sql)
    names = [x[0] for x in got.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
