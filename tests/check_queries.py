"""Run catalog queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/check_queries.py 0.001 [name ...]
"""

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, folder, name, sql):
    df = contract.queries()[name](spark, folder)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows={len(got)} (no SQL)" if got else "EMPTY"
    cur = con.execute(sql)
    want, want_cols = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"COLUMNS {got_cols} != {want_cols}"
    if got != want:
        extra, missing = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"DIFF {len(got)} vs {len(want)} rows; spark only {str(extra)[:400]}; sql only {str(missing)[:400]}"
    return f"ok rows={len(got)}"


if __name__ == "__main__":
    from pagelode.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = contract.oracle_sql()
    for name in names:
        started = time.time()
        try:
            outcome = compare(spark, con, folder, name, sqls.get(name))
        except Exception as error:
            outcome = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name}: {outcome} [{time.time() - started:.1f}s]", flush=True)
