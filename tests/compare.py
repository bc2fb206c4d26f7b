"""Spark against DuckDB on the same tables."""

import math
import os
from collections import Counter

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def engine():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


def cells(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 6))
        return repr(sorted(x.items())) if isinstance(x, dict) else repr(x)

    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def same(spark, con, run, sql):
    df = run(spark, DATA)
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    ours, theirs = cells(map(tuple, df.collect()), df.columns), cells(got.fetchall(), names)
    assert ours == theirs, (list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
