"""Run registered queries and their SQL twins side by side and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same bag of rows under the same column names."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    ordered = sorted(names)
    place = [names.index(n) for n in ordered]
    expected = Counter(tuple(row[i] for i in place) for row in cursor.fetchall())
    found = Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in ordered]).collect())
    if found == expected:
        return ""
    extra, lacking = found - expected, expected - found
    example = (list(extra)[:1], list(lacking)[:1])
    return f"{sum(found.values())} vs {sum(expected.values())} rows; {len(extra)} extra, {len(lacking)} lacking: {example}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            difference = compare(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(difference)
        print(f"{name:28s} {time.time() - start:6.2f}s {difference or 'ok'}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
