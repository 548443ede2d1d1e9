"""Run queries and their SQL twins, compare all rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, name, fn, sql, folder):
    """(rows, problem or None, spark seconds, duckdb seconds)."""
    start = time.time()
    df = fn(spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return len(got), None, took, 0.0
    start = time.time()
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    sql_took = time.time() - start
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}", took, sql_took
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return len(got), f"rows {len(got)} vs {len(want)}; spark only {extra}; sql only {missing}", took, sql_took
    return len(got), None, took, sql_took


def main() -> int:
    from tidewell import queries
    from tidewell.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    try:
        queries.load()
    except ImportError as error:
        print("partial load:", error)
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                             "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, fn in queries.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            n, problem, took, sql_took = compare(spark, con, name, fn, queries.ORACLES.get(name), folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            n, problem, took, sql_took = 0, f"{type(error).__name__}: {str(error)[:700]}", 0.0, 0.0
        bad += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in queries.ORACLES else "rows")
        print(f"{mark} {name:28s} rows={n:<7d} spark={took:6.2f}s sql={sql_took:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
