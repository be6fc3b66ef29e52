"""Compare named queries with their SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}") + 0.0
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return str(value) if value is not None and not isinstance(value, bool) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, con, folder, name, function, sql):
    started = time.time()
    df = function(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_seconds = time.time() - started
    if not sql:
        return f"rows-only {len(got[1])}", spark_seconds, 0.0
    started = time.time()
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    seconds = time.time() - started
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} vs {want[0]}", spark_seconds, seconds
    if len(got[1]) != len(want[1]):
        return f"COUNT {len(got[1])} vs {len(want[1])}", spark_seconds, seconds
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"VALUES {len(bad)} of {len(got[1])}: {bad[0]}", spark_seconds, seconds
    return f"ok {len(got[1])}", spark_seconds, seconds


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from colsieve.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    for name, function in entry.queries().items():
        if only and name not in only:
            continue
        try:
            text, a, b = compare(spark, con, folder, name, function, sqls.get(name))
        except Exception as error:
            text, a, b = f"ERROR {type(error).__name__}: {str(error)[:700]}", 0.0, 0.0
        print(f"{name:32s} spark {a:6.2f}s sql {b:6.2f}s  {text}", flush=True)
