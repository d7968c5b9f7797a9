from __future__ import annotations

import datetime as dt
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


def same(a, b) -> bool:
    """Do both hold the same bag of rows, columns matched by name?"""
    columns = [f"`{c}`" for c in a.columns]
    found, expected = (Counter(map(tuple, df.select(*columns).collect())) for df in (a, b))
    return sorted(a.columns) == sorted(b.columns) and found == expected


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Price rows of one or more stocks from lists of closes, one bar per day."""
    from quotewright import schemas as s

    def build(**closes):
        rows = []
        for stock, values in closes.items():
            for i, close in enumerate(values):
                day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
                rows.append((f"{stock}:{i:05d}", stock, stock.upper(), day, close, close, close, 1, close))
        return spark.createDataFrame(rows, s.PRICES)

    return build


@pytest.fixture
def by_day():
    """Values of one stock's columns, oldest first."""

    def read(df, *columns, stock=None):
        rows = df.filter(f"stock_id = '{stock}'") if stock else df
        picked = rows.orderBy("stock_id", "date", "transaction_id").select(*[f"`{c}`" for c in columns]).collect()
        return [row[0] for row in picked] if len(columns) == 1 else [tuple(row) for row in picked]

    return read
