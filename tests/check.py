"""Runs registered queries on a data folder and compares them with the SQL oracle.

    python tests/check.py [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from shelfmark.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value: object) -> object:
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return (2, "nan" if math.isnan(number) else f"{round(number, 6) + 0.0:.6f}")
    return (3, str(value))


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, folder: str) -> str:
    frame = entry.queries()[name](spark, folder)
    columns = frame.columns
    got = [tuple(row) for row in frame.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(got)})" if got else "EMPTY"
    result = connection.sql(sql)
    wanted_columns, wanted = result.columns, result.fetchall()
    if sorted(columns) != sorted(wanted_columns):
        return f"COLUMNS spark-only {sorted(set(columns) - set(wanted_columns))} sql-only {sorted(set(wanted_columns) - set(columns))}"
    a, b = rows_of(columns, got), rows_of(wanted_columns, wanted)
    if a == b:
        return f"ok ({len(a)})" if a else "EMPTY"
    first = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    names = sorted(columns)
    detail = ""
    if first < min(len(a), len(b)):
        detail = str([(n, x[1], y[1]) for n, x, y in zip(names, a[first], b[first]) if x != y])
        detail += " at " + str([v[1] for v in a[first]][:6])
    bad = sum(x != y for x, y in zip(a, b))
    return f"DIFF rows {len(a)} vs {len(b)}, {bad} differ; {detail[:700]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(args.dir)
    names = args.names or list(entry.queries())
    failures = 0
    for name in names:
        started = time.time()
        try:
            outcome = compare(spark, connection, name, args.dir)
        except Exception as problem:  # noqa: BLE001
            outcome = f"ERROR {type(problem).__name__}: {str(problem)[:900]}"
        if not outcome.startswith(("ok", "rows only")):
            failures += 1
        print(f"{time.time() - started:6.2f}s {name:32s} {outcome}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
