"""Run registered queries and their SQL side by side: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=repr)


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql: str):
    result = con.execute(sql)
    return _table([d[0] for d in result.description], result.fetchall())


def difference(got, want) -> str | None:
    """None when equal, else the first difference."""
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"row count {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if repr(a) != repr(b)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("tickloom-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = argv[1:] or list(entry.queries())
    con, spark, failed = connect(sf_dir), session(), []
    for name in names:
        began = time.time()
        try:
            got = spark_table(entry.queries()[name](spark, sf_dir))
            sql = entry.oracle_sql().get(name)
            problem = difference(got, sql_table(con, sql)) if sql else None
            verdict = problem or ("ok" if sql else "rows only")
        except Exception as error:
            problem = verdict = f"{type(error).__name__}: {str(error)[:600]}"
            got = ([], [])
        print(f"{name:28s} {time.time() - began:6.2f}s rows={len(got[1]):6d} {verdict}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
