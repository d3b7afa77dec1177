"""Compare every query with its SQL twin: python tools/check.py [sf dir] [query ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int, float]:
    start = time.time()
    df = QUERIES[name].run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if QUERIES[name].sql is None:
        return ("rows only" if got else "EMPTY"), len(got), took
    result = con.execute(QUERIES[name].sql)
    columns, want = [c[0] for c in result.description], result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} {sorted(columns)}", len(got), took
    left, right = normal(df.columns, got), normal(columns, want)
    if left != right:
        only = [r for r in left if r not in right[:50000]][:3] if len(left) < 3000 else [
            (a, b) for a, b in zip(left, right) if a != b
        ][:3]
        other = [r for r in right if r not in left][:3] if len(left) < 3000 else []
        return f"DIFFERS {len(left)} {len(right)} {only} {other}", len(got), took
    return ("ok" if got else "ok but EMPTY"), len(got), took


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(shuffle_partitions=int(os.environ.get("CHECK_PARTITIONS", "8"))), database(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict, rows, took = compare(spark, con, name, sf_dir)
        except Exception as problem:  # report all queries, not only the first failing one
            verdict, rows, took = f"FAILED {type(problem).__name__} {str(problem)[:600]}", 0, 0.0
        bad += verdict not in ("ok", "rows only")
        print(f"{name:32s} {rows:8d} {took:7.2f}s {verdict}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")


if __name__ == "__main__":
    main()
