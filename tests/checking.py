"""Compare a Spark query with its SQL on the same Parquet tables."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(shaped, key=repr)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(*sql_rows(sf_dir, sql))
    assert got[0] == want[0], f"columns {got[0]} differ from {want[0]}"
    if got[1] != want[1]:
        only_got = [r for r in got[1] if r not in set(want[1])][:3]
        only_want = [r for r in want[1] if r not in set(got[1])][:3]
        raise AssertionError(
            f"{len(got[1])} rows against {len(want[1])}; only Spark {only_got}; only SQL {only_want}"
        )
    return len(got[1])
