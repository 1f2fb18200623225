"""Compare the registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridclim import queries  # noqa: E402
from gridclim.session import local_session  # noqa: E402
from gridclim.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, isinstance(v, str), str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def compare(df, con, sql: str, empty_ok: bool = False) -> str | None:
    """None when rows, names and values agree, else what differs."""
    order = sorted(df.columns)
    got = [tuple(_normal(v) for v in r) for r in df.select(*order).collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != order:
        return f"columns {order} != {sorted(names)}"
    idx = [names.index(n) for n in order]
    want = [tuple(_normal(r[i]) for i in idx) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return None if empty_ok else "no rows"
    got.sort(key=_key)
    want.sort(key=_key)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ on {order}: {bad[:2]}"
    kinds = [
        (n, type(a).__name__, type(b).__name__)
        for n, a, b in zip(order, got[0], want[0])
        if a is not None and b is not None and type(a) is not type(b)
    ]
    return f"types differ: {kinds}" if kinds else None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    queries.load_all()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    failed = 0
    chosen = [n for n in queries.QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    for name in chosen:
        t = time.time()
        try:
            df = queries.QUERIES[name](spark, args.sf)
            if name in queries.SQL:
                problem = compare(df, con, queries.SQL[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        kind = "" if name in queries.SQL else " (rows only)"
        print(f"{mark} {name}{kind} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
