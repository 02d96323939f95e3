"""Compare registered queries with their SQL in DuckDB.

Usage: python tests/compare.py [folder] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    cur = con.execute(sql)
    return table([c[0] for c in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}; {_first(got[1], want[1])}"
    if got[1] != want[1] or repr(got[1]) != repr(want[1]):
        return _first(got[1], want[1])
    return None


def _first(a, b) -> str:
    left, right = set(map(repr, a)), set(map(repr, b))
    return f"only spark {sorted(left - right)[:3]} | only sql {sorted(right - left)[:3]}"


def main() -> int:
    from driver_queries import QUERIES, SQL
    from tests.sessions import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark, con = local_session(), connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            got = spark_table(run(spark, folder))
            spent = time.time() - start
            diff = difference(got, sql_table(con, SQL[name])) if name in SQL else None
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            spent = time.time() - start
            got, diff = ([], []), f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        state = "FAIL " + diff if diff else ("ok" if name in SQL else "ok (no SQL)")
        print(f"{name:34s} {len(got[1]):8d} rows {spent:6.2f}s {state}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
