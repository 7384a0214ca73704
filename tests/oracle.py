"""Side-by-side check of a registered query with its SQL twin, values compared exactly and without order."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

from lotwise.sources.tables import SCHEMAS


def connect(folder: str):
    connection = duckdb.connect()
    for name in SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, decimal.Decimal):
        return f"d{value.normalize():f}" if value else "d0"
    if isinstance(value, float):
        return f"f{value!r}" if value else "f0"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(item) for item in value) + "]"
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, folder: str) -> tuple[str, str, float]:
    """(verdict, detail, seconds of the Spark side)."""
    started = time.time()
    df = query(spark, folder)
    rows = [tuple(row) for row in df.collect()]
    seconds = time.time() - started
    left = normal(df.columns, rows)
    if query.sql is None:
        return ("rows-only" if rows else "empty"), f"{len(rows)} rows", seconds
    cursor = connection.execute(query.sql)
    right = normal([item[0] for item in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return "columns", f"{left[0]} != {right[0]}", seconds
    if len(left[1]) != len(right[1]):
        return "count", f"{len(left[1])} != {len(right[1])}: {left[1][:2]} / {right[1][:2]}", seconds
    for mine, theirs in zip(*[side[1] for side in (left, right)]):
        if mine != theirs:
            return "values", f"{left[0]} {mine} != {theirs}", seconds
    return ("ok" if rows else "empty"), f"{len(rows)} rows", seconds


def main(arguments) -> None:
    import __spark_entry__  # noqa: F401
    from lotwise.plans.registry import CATALOGUE
    from lotwise.session import local_session

    folder = arguments[0]
    wanted = arguments[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for key, query in CATALOGUE.items():
        if wanted and not any(key == item or key.startswith(item + "-") for item in wanted):
            continue
        try:
            verdict, detail, seconds = compare(spark, connection, query, folder)
        except Exception as error:  # report and go on to the next query
            verdict, detail, seconds = "error", f"{type(error).__name__}: {str(error)[:700]}", 0.0
        bad += verdict not in ("ok", "rows-only")
        print(f"{verdict:9} {key:12} {seconds:6.2f}s {detail}", flush=True)
    print(f"{bad} not ok")


if __name__ == "__main__":
    main(sys.argv[1:])
