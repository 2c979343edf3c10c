"""Compare registered queries with their SQL on the given tables.

Usage: python tests/check_queries.py SF_DIR [name ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from barograph.session import clear_scratch  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """Empty when equal, otherwise what differs."""
    found = entry.queries()[name](spark, sf_dir)
    columns, rows = found.columns, found.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if columns else "no columns"
    wanted = connection.execute(sql)
    wanted_columns = [d[0] for d in wanted.description]
    wanted_rows = wanted.fetchall()
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(columns)} != {sorted(wanted_columns)}"
    if len(rows) != len(wanted_rows):
        return f"{len(rows)} rows != {len(wanted_rows)}"
    left, right = normal(columns, rows), normal(wanted_columns, wanted_rows)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, e.g. {wrong[0]}" if wrong else ""


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir, *names = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names or entry.queries():
        started = time.monotonic()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report every query, not only the first failure
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        clear_scratch(spark)
        failures += bool(problem)
        checked = "sql " if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {checked} {time.monotonic() - started:6.2f}s {name} {problem}",
              flush=True)
    print(f"{failures} failures")
    sys.exit(bool(failures))


if __name__ == "__main__":
    main()
