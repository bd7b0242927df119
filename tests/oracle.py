"""Compare a query with its SQL on DuckDB, row by row."""

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict) or hasattr(x, "asDict"):
        return tuple(map(plain, (x if isinstance(x, dict) else x.asDict()).values()))
    return x if isinstance(x, (str, bytes, bool, int)) else str(x)


def compare(spark, sf, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet") or glob.glob(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    df = query(spark, sf)
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    order = sorted(names)
    ours = sorted((tuple(plain(r[n]) for n in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[names.index(n)]) for n in order) for r in want.fetchall()), key=repr)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    wrong = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    assert not wrong, (order, wrong[:3])
    return len(ours)
