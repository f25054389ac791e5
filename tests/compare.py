"""Run registered queries on Spark and their comparison SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return repr(value)
    if isinstance(value, (decimal.Decimal, dt.date, dt.datetime, list, dict)):
        raise TypeError(f"keep query outputs to numbers, text and flags: {value!r}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, folder):
    started = time.time()
    df = query.run(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if query.sql is None:
        return f"rows only ({len(got)})", True, took
    res = con.execute(query.sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", False, took
    if got == want:
        return f"{len(got)} rows", len(got) > 0, took
    a, b = set(got), set(want)
    return f"{len(got)} vs {len(want)}; only spark {list(a - b)[:3]}; only sql {list(b - a)[:3]}", False, took


def main() -> int:
    sys.path.insert(0, ".")
    from reelhouse.catalog import load_catalog
    from reelhouse.session import local_session

    folder = "/root/testdata/sf0.01"
    picks = [a for a in sys.argv[1:] if not a.startswith("/")]
    for a in sys.argv[1:]:
        if a.startswith("/"):
            folder = a
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name, q in load_catalog().items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        try:
            text, ok, took = compare(spark, con, name, q, folder)
        except Exception as e:  # report and go on with the next query
            text, ok, took = f"{type(e).__name__}: {str(e)[:700]}", False, 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {took:.1f}s {text}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
