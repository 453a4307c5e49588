"""Runs registered queries next to their SQL and reports what differs.

Usage: python -m checks.compare DIR [query ...]
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


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> list[str]:
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = Counter(tuple(row) for row in frame.select(*(f"`{c}`" for c in columns)).collect())
    relation = connection.sql(ORACLES[name])
    if sorted(relation.columns) != columns:
        return [f"columns {columns} against {sorted(relation.columns)}"]
    quoted = ", ".join(f'"{column}"' for column in columns)
    expected = Counter(relation.project(quoted).fetchall())
    missing, surplus = expected - found, found - expected
    report = []
    if missing or surplus:
        report.append(
            f"{found.total()} rows against {expected.total()}: {missing.total()} missing "
            f"{list(missing)[:3]}, {surplus.total()} surplus {list(surplus)[:3]}"
        )
    if not found:
        report.append("no rows")
    return report


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        report = differences(spark, connection, sf_dir, name) if name in ORACLES else []
        failed += bool(report)
        print(f"{'DIFFERS' if report else 'same':8}{name} {time.time() - start:.2f}s", *report)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    raise SystemExit(bool(main(sys.argv[1], sys.argv[2:])))
