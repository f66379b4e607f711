"""Run one query in Spark and its SQL in DuckDB and compare the rows regardless of order."""

import datetime as dt
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value + 0.0:.9g}"
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 10**9 else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in data]
    return sorted(out, key=repr)


def compare(df, con, sql):
    names = df.columns
    mine = rows(names, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs = rows(theirs_names, result.fetchall())
    assert sorted(names) == sorted(theirs_names), (sorted(names), sorted(theirs_names))
    if mine != theirs:
        diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:3]
        raise AssertionError(f"{len(mine)} rows vs {len(theirs)} rows; first differences {diff}")
    return len(mine)
