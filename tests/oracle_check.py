"""Run every query next to its SQL and compare the results.

    python tests/oracle_check.py [sf] [name-prefix ...]"""
from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(d: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9))
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """None when equal, else a short text."""
    got_cols, got = rows_of(df.columns, df.collect())
    table = con.sql(sql)
    want_cols, want = rows_of(list(table.columns), table.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {str(bad[0][0])[:300]} != {str(bad[0][1])[:300]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from newsops.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    d = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(d)
    failed = 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t = time.time()
        try:
            df = fn(spark, d)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problem, n = None, df.count()
                note = f"rows only: {n}"
                problem = None if n else "no rows"
            else:
                problem, note = compare(df, con, sql), "equal"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.1f}s {problem or note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
