"""Compare a registered query with its SQL in DuckDB."""

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if isinstance(x, (datetime.date, datetime.datetime)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def coarse(x):
    return round(x, 4) if isinstance(x, float) else tuple(map(coarse, x)) if isinstance(x, tuple) else x


def rows(names, data):
    """Rows in the order of their rounded values, so that the last digits do not decide which are compared."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=lambda r: (repr(coarse(r)), repr(r)))


def difference(spark, con, sf_dir, query, sql):
    """None, or what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; {[x for x in got if x not in want[:5000]][:3]} and {[x for x in want if x not in got[:5000]][:3]}"
    for a, b in zip(got, want, strict=True):
        same = all(x == y or isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1.5e-6) for x, y in zip(a, b, strict=True))
        if not same:
            return f"{a} and {b}"
    return None
