"""Run named queries and their SQL twins side by side and compare rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def kind(v):
    return type(v).__name__


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, fn, sql):
    """None when equal, else a short text."""
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    ran = con.execute(sql)
    want_cols = [d[0] for d in ran.description]
    want = ran.fetchall()
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if a[0] != b[0]:
        return f"columns {a[0]} / {b[0]}"
    if got and want:
        types = {c: {kind(r[i]) for r in got} - {"NoneType"} for i, c in enumerate(df.columns)}
        other = {c: {kind(r[i]) for r in want} - {"NoneType"} for i, c in enumerate(want_cols)}
        bad = {c: (types[c], other[c]) for c in types if types[c] and other[c] and types[c] != other[c]}
        if bad:
            return f"types {bad}"
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} / {len(b[1])}"
    diff = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else None


def main():
    from __spark_entry__ import oracle_sql, queries
    from riskweave.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if sqls.get(name):
                result = compare(spark, con, sf, fn, sqls[name])
            else:
                result = None if fn(spark, sf).collect() else "no rows"
        except Exception as e:  # report every query
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None
        mark = "ok  " if result is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s{'' if sqls.get(name) else ' (rows only)'} {result or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
