"""Run every registered query against its SQL on one folder of test tables.

``python tests/compare.py [folder] [query ...]``; also used by the test suite.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, connection, folder: str, name: str) -> tuple[int, list[str]]:
    """Row count and descriptions of mismatches between the query and its SQL."""
    ours = entry.queries()[name](spark, folder)
    relation = connection.sql(entry.oracle_sql()[name])
    if sorted(ours.columns) != sorted(relation.columns):
        return 0, [f"columns {sorted(ours.columns)} != {sorted(relation.columns)}"]
    got, want = _bag(ours.columns, ours.collect()), _bag(relation.columns, relation.fetchall())
    extra, missing = got - want, want - got
    found = [f"extra {row}" for row in list(extra)[:3]]
    found += [f"missing {row}" for row in list(missing)[:3]]
    kinds = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "DATE": "date", "BOOLEAN": "boolean",
    }
    types = dict(ours.dtypes)
    for column, kind in zip(relation.columns, relation.types):
        if kinds.get(str(kind), str(kind)) != types[column]:
            found.append(f"type of {column}: {types[column]} != {kind}")
    return sum(got.values()), found


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in sys.argv[2:] or entry.oracle_sql():
        start = time.time()
        rows, found = differences(spark, connection, folder, name)
        print(f"{name:30s} {rows:8d} {time.time() - start:6.1f}s", "OK" if not found else found,
              flush=True)
