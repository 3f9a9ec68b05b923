"""Runs a registered query in Spark and its SQL counterpart in DuckDB and compares the rows."""

import glob
import math
import os

import duckdb

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{files}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return repr(v + 0.0) if isinstance(v, float) else repr(v)


def compare(con, df, text):
    """Asserts equal column names, types and rows; returns the row count."""
    cursor = con.execute(text)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == kinds
    order = sorted(names)
    want = sorted(tuple(plain(row[names.index(c)]) for c in order) for row in cursor.fetchall())
    got = sorted(tuple(plain(row[c]) for c in order) for row in df.collect())
    assert got == want
    return len(got)
