"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows.

    python tests/compare.py [SF_DIR] [NAME ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return str(value)


def sorted_rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same rows; else a short report."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = sorted_rows(names, cur.fetchall())
    got_cols, got = sorted_rows(spark_df.columns, spark_df.collect())
    if got_cols != want_cols:
        return f"columns differ: only Spark {sorted(set(got_cols) - set(want_cols))}, only SQL {sorted(set(want_cols) - set(got_cols))}"
    if len(got) != len(want):
        return f"{len(got)} rows on Spark, {len(want)} in SQL"
    if got != want:
        a, b = set(got), set(want)
        only_got, only_want = sorted(a - b)[:2], sorted(b - a)[:2]
        bad = {got_cols[i] for x, y in zip(sorted(a - b), sorted(b - a)) for i in range(len(x)) if x[i] != y[i]}
        return f"{len(a - b)} rows differ in {sorted(bad)}\n  spark {only_got}\n  sql   {only_want}"
    return None


def main(sf: str, names: list[str]) -> int:
    from tidewatch.registry import BOOK
    from tidewatch.session import local_session

    spark, con, failed = local_session(8), oracle(sf), 0
    for name in names or list(BOOK):
        q = BOOK[name]
        start = time.time()
        try:
            df = q.run(spark, sf)
            report = difference(df, con, q.sql) if q.sql else (f"{df.count()} rows, no SQL" and None)
        except Exception as e:  # noqa: BLE001
            report = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += report is not None
        print(f"{'ok  ' if report is None else 'FAIL'} {name} {time.time() - start:.1f}s {report or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
