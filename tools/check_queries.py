"""Run registered queries and their SQL side by side and report differences.

Usage: python tools/check_queries.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from meterline.registry import CHECK_SQL, QUERIES  # noqa: E402
from meterline.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


TYPES = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return db


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def kind(v) -> str:
    return {bool: "bool", int: "int", float: "float", str: "str"}.get(type(v), type(v).__name__)


def compare(spark, db, name: str, sf_dir: str) -> str:
    """'' when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got, names = [tuple(r) for r in df.collect()], df.columns
    if name not in CHECK_SQL:
        return "" if got else "no rows"
    cur = db.execute(CHECK_SQL[name])
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if os.environ.get("CHECK_TYPES"):
        theirs = {d[0]: str(d[1]) for d in cur.description}
        odd = {n: (t, theirs.get(n)) for n, t in df.dtypes if TYPES.get(t, t.upper()) != theirs.get(n)}
        if odd:
            print(f"type {name} {odd}", flush=True)
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(names, got), rows_of(want_names, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {bad[0]}"
    return "" if got else "no rows"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if args and not any(name.startswith(p) for p in args):
            continue
        t0 = time.time()
        try:
            problem = compare(spark, db, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        tag = "ok  " if not problem else "FAIL"
        print(f"{tag} {name:40s} {time.time() - t0:6.2f}s {'' if name in CHECK_SQL else '(rows only) '}{problem}", flush=True)
    print(f"{failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
