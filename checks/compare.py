"""Runs queries and their SQL side by side and reports every difference.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def oracle_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    """Column types and rows of an SQL text."""
    with duckdb.connect() as connection:
        for file in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        cursor = connection.execute(sql)
        return {c[0]: str(c[1]) for c in cursor.description}, cursor.fetchall()


def difference(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Row count of a query and what differs from its SQL; nothing if both agree exactly."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    rows = [tuple(r) for r in result.select(*columns).collect()]
    if name not in ORACLES:
        return len(rows), []
    types, found = oracle_rows(sf_dir, ORACLES[name])
    ours = {column: TYPES.get(kind, kind) for column, kind in result.dtypes}
    if ours != types:
        return len(rows), [f"columns differ: {sorted(ours.items() ^ types.items())}"]
    names = list(types)
    order = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in found]
    ours, theirs = Counter(map(repr, rows)), Counter(map(repr, expected))
    problems = [f"only in query: {r}" for r in list((ours - theirs))[:3]]
    problems += [f"only in SQL:   {r}" for r in list((theirs - ours))[:3]]
    if len(rows) != len(expected):
        problems.append(f"{len(rows)} rows != {len(expected)}")
    return len(rows), problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            n, problems = difference(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        kind = "SQL" if name in ORACLES else "rows only"
        state = "FAIL" if problems else "ok"
        print(f"{state:4} {name:26} {n:8} rows {time.time() - start:6.1f} s  {kind}", flush=True)
        for p in problems:
            print("     ", p)
        failed += bool(problems)
    return failed


if __name__ == "__main__":
    sys.exit(main())
