"""Run a registered query and its SQL twin, and compare rows regardless of order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = pathlib.Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    )


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return canonical(columns, cur.fetchall())


def differences(mine, theirs, show=3):
    (c1, r1), (c2, r2) = mine, theirs
    if c1 != c2:
        return f"columns differ: {c1} / {c2}"
    if r1 == r2:
        return None
    from collections import Counter

    a, b = Counter(r1), Counter(r2)
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return (
        f"rows {len(r1)}/{len(r2)}; only spark {len(only_a)}, only sql {len(only_b)}\n  columns {c1}\n"
        + "".join(f"  spark {r}\n" for r in only_a[:show])
        + "".join(f"  sql   {r}\n" for r in only_b[:show])
    )
