"""Compare registered Spark queries against their DuckDB oracles.

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows (columns sorted by name, values compared exactly).  Run as a
script for a report: ``python tests/oracle_harness.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, tol: float | None = None):
    """Return None when equal, else a short description of the first difference."""
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return f"row count spark={len(a)} duck={len(b)}"
    for ra, rb in zip(a, b):
        for c, x, y in zip(order, ra, rb):
            if x == y:
                continue
            if isinstance(x, bool) or isinstance(y, bool):
                return f"{c}: {x!r} != {y!r}"
            if tol is not None and isinstance(x, (int, float)) and isinstance(y, (int, float)) \
                    and abs(x - y) <= tol * max(1.0, abs(x), abs(y)):
                continue
            return f"{c}: spark={x!r} duck={y!r} row={ra}"
    return None


def run(sf_dir: str, keys: list[str] | None = None, spark=None, verbose: bool = True) -> dict[str, str]:
    import __spark_entry__ as E
    from trailcheck.session import get_session

    spark = spark or get_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    results: dict[str, str] = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            rows = df.collect()
            cols = df.columns
            t1 = time.time()
            if k not in oracle:
                results[k] = f"rows-only ({len(rows)} rows)"
            else:
                cur = con.execute(oracle[k])
                drows = cur.fetchall()
                dcols = [d[0] for d in cur.description]
                diff = compare(rows, cols, drows, dcols)
                if diff is None:
                    results[k] = f"OK ({len(rows)} rows)"
                else:
                    near = compare(rows, cols, drows, dcols, tol=1e-9)
                    results[k] = ("NEAR " if near is None else "FAIL ") + diff
            if verbose:
                print(f"{k:32s} {t1 - t0:6.2f}s  {results[k]}", flush=True)
        except Exception as exc:  # report and continue
            results[k] = f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
            if verbose:
                print(f"{k:32s} {results[k]}", flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
