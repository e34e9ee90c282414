"""Run a query in Spark and its SQL twin in DuckDB, compare the results.

Used by the tests and as a CLI: ``python -m tests.twin [sf_dir] [name ...]``.
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name; floats compared with a relative tolerance of 1e-9.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, str(round(v, 6)) if isinstance(v, float) else str(v)) for v in row)


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            a, b = float(a), float(b)
        except (TypeError, ValueError):
            return False
        return a == b or abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark, con, name, fn, sql, sf_dir, tol=1e-9):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only={sorted(set(s_cols)-set(d_cols))} sql-only={sorted(set(d_cols)-set(s_cols))}")
        return problems, (t1 - t0, t2 - t1)
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_sorted = sorted((tuple(r[i] for i in si) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[i] for i in di) for r in d_rows), key=_key)
    if len(s_sorted) != len(d_sorted):
        problems.append(f"row count spark={len(s_sorted)} sql={len(d_sorted)}")
    bad = 0
    for a, b in zip(s_sorted, d_sorted):
        if not all(_close(x, y, tol) for x, y in zip(a, b)):
            if bad < 3:
                diffs = [(order[i], x, y) for i, (x, y) in enumerate(zip(a, b)) if not _close(x, y, tol)]
                problems.append(f"row differs: {diffs[:6]}")
            bad += 1
    if bad:
        problems.append(f"{bad} differing rows")
    return problems, (t1 - t0, t2 - t1)


def main(argv):
    sys.path.insert(0, ".")
    from lendlake.session import local_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    fails = 0
    for name in names or list(sqls):
        probs, (ts, td) = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        status = "OK  " if not probs else "FAIL"
        fails += bool(probs)
        print(f"{status} {name:34s} spark={ts:6.2f}s duck={td:6.2f}s {'; '.join(probs)[:600]}", flush=True)
    print(f"{fails} failing of {len(names or sqls)}")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
