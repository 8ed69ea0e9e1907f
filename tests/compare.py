"""Run registered queries beside their reference SQL and compare the rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, function, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    got = function(spark, sf_dir)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} but expected {sorted(columns)}"
    expected = rows_of(columns, cursor.fetchall())
    actual = rows_of(got.columns, got.collect())
    if actual == expected:
        return None if actual else "both sides are empty"
    extra, lacking = actual - expected, expected - actual
    return f"{sum(actual.values())} rows, expected {sum(expected.values())}; extra {list(extra)[:2]}; lacking {list(lacking)[:2]}"


if __name__ == "__main__":
    from pathlib import Path
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    con = connect(sf_dir)
    chosen = sys.argv[2:]
    failures = 0
    for name, function in contract.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        started = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            problem = compare(spark, con, name, function, sql, sf_dir) if sql else f"no SQL; {function(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failures} problems")
