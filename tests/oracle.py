"""Run a registered query and its SQL twin and compare the rows, ignoring their order."""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("n", float(value))
    if isinstance(value, (int, float)):
        return ("nan",) if isinstance(value, float) and math.isnan(value) else ("n", round(float(value), 6))
    if hasattr(value, "as_tuple"):
        return ("n", round(float(value), 6))
    return ("s", str(value))


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, folder, query, sql):
    """None if equal, else a text that says what differs."""
    df = query(spark, folder)
    got_columns, got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_columns, want = sorted_rows(columns, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{got_columns}\n  got  {a}\n  want {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from trackframe.session import builder

    spark = (
        builder("oracle").master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:]
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            fault = compare(spark, folder, queries[name], sql.get(name))
        except Exception as e:
            fault = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "" if name in sql else " (rows only)"
        print(f"{'ok  ' if fault is None else 'FAIL'} {name}{kind} {time.time() - start:.1f}s", fault or "", flush=True)
