"""Run the queries beside their SQL and compare whole results, columns taken by name."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, run, sql: str, sf: str) -> str | None:
    """What differs between Spark and the SQL, or None."""
    frame = run(spark, sf)
    left_cols, left = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    right_cols, right = canonical([d[0] for d in result.description], result.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


if __name__ == "__main__":
    from __spark_entry__ import ORACLES, QUERIES
    from tallyroute.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                found = difference(spark, con, QUERIES[name], ORACLES[name], sf)
            else:
                found = None if QUERIES[name](spark, sf).collect() else "no rows"
        except Exception as exc:
            found = "".join(traceback.format_exception_only(exc))[:600]
        if found:
            failed.append(name)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
