"""Runs registered queries next to their SQL."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as registry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(registry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in chosen:
        started = time.time()
        try:
            got = spark_rows(registry.queries()[name](spark, sf_dir))
            took = time.time() - started
            want = sql_rows(registry.oracle_sql()[name], sf_dir)
            verdict = "ok" if got == want else "DIFFERENT"
            print(f"{name:24} {verdict:10} {len(got[1]):7} rows  {took:6.2f}s", flush=True)
            if got != want:
                print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                for a, b in [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]:
                    print("  spark", str(a)[:600], "\n  sql  ", str(b)[:600])
        except Exception as error:
            print(f"{name:24} FAILED {type(error).__name__}: {str(error)[:1200]}", flush=True)
