"""Runs a query and its DuckDB SQL over the same small tables and compares the rows."""

import glob
import math
import os

import duckdb


def duck(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(f)[:-8]
        c.execute(f"create view {name} as select * from '{f}{'/*.parquet' if os.path.isdir(f) else ''}'")
    return c


def key(row):
    return tuple((x is None, round(x, 6) if isinstance(x, float) and not math.isnan(x) else str(x)) if not isinstance(x, float) else (False, f"{x:.6f}") for x in row)


def same(df, sql, sf):
    cols = sorted(df.columns)
    got = sorted(key(r) for r in df.select(*cols).collect())
    want = sorted(key(r) for r in duck(sf).sql(f"select {', '.join(cols)} from ({sql})").fetchall())
    assert len(got) == len(want), (len(got), len(want))
    assert got == want, next((g, w) for g, w in zip(got, want) if g != w)
