"""Compares a query with its SQL as the driver does: columns by name, rows without order."""

import glob
import math
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(DATA + "/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(canon, v)) + "]"
    if getattr(v, "tzinfo", None):
        v = v.replace(tzinfo=None)
    return str(v)


def same(spark, c, query, sql):
    df = query(spark, DATA)
    cols = sorted(df.columns)
    got = sorted("|".join(canon(r[x]) for x in cols) for r in df.collect())
    rows = c.execute(sql)
    names = [d[0] for d in rows.description]
    want = sorted("|".join(canon(r[names.index(k)]) for k in cols) for r in rows.fetchall())
    assert sorted(names) == cols
    assert got == want
