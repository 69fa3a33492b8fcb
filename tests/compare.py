"""Run a query in Spark and its SQL in DuckDB, and compare all values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return f"{v:.4f}".replace("-0.0000", "0.0000")
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str):
    """None if equal, else a text that says what differs."""
    left = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    right = rows_of([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[1] == right[1]:
        return None
    a, b = set(left[1]), set(right[1])
    return (f"rows {len(left[1])} / {len(right[1])}; columns {left[0]}\n  only here: {sorted(a - b)[:3]}"
            f"\n  only there: {sorted(b - a)[:3]}")


def main(folder: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from leadflow.session import build_session

    spark = build_session("local[8]", 8)
    con, sqls, bad = duck(folder), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            n = df.count() if name not in sqls else None
            diff = compare(df, con, sqls[name]) if name in sqls else None
        except Exception as e:  # show and go on
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", None
        took = time.time() - start
        print(f"{'FAIL' if diff else 'ok  '} {name} {took:.1f}s {'' if n is None else f'rows only: {n}'}", flush=True)
        if diff:
            bad += 1
            print("  " + diff, flush=True)
    print(f"{bad} differ", flush=True)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
