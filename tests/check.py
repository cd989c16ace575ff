"""Compare registered queries with their SQL on one data directory.

usage: python tests/check.py [sf_dir] [name ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from tessera.plans.queries import CHECKS, QUERIES, TABLES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([normal(r[i]) for i in order]) for r in rows)


def compare(con, frame, sql):
    """None if both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if got != expected:
        left, right = set(got), set(expected)
        extra, missing = sorted(left - right)[:3], sorted(right - left)[:3]
        return f"{len(got)} rows, expected {len(expected)}; extra {extra}; missing {missing}"
    return None if got else "no rows"


def main():
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sf_dir, names = args[0], args[1:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            n = frame.count() if name not in CHECKS else 0
            spent = time.time() - start
            problem = compare(con, frame, CHECKS[name]) if name in CHECKS else (None if n else "no rows")
        except Exception as exc:
            problem, spent = f"{type(exc).__name__}: {str(exc)[:1500]}", time.time() - start
        print(f"{'FAIL' if problem else 'ok  '} {name} {spent:.1f}s {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
