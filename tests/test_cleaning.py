from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quotewright import schemas as s
from quotewright.operators import cleaning, quality

DAY = dt.date(2020, 1, 1)


@pytest.fixture
def dirty(spark):
    rows = [
        ("t3", "a", "A", DAY, 1.0, 1.0, 1.0, None, 5.0),
        ("t1", "a", "A", DAY, 1.0, 1.0, 1.0, 7, 5.0),
        ("t2", "a", "A", DAY, 1.0, 1.0, 1.0, 7, 6.0),
        ("t0", "b", "B", DAY, 1.0, 1.0, 1.0, None, 5.0),
    ]
    return spark.createDataFrame(rows, s.PRICES)


def ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_copies_are_dropped_within_a_ticker(dirty):
    assert ids(cleaning.clean(dirty)) == ["t0", "t1", "t2"]


def test_global_key_drops_across_tickers(dirty):
    assert ids(cleaning.clean(dirty, cleaning.GLOBAL_COPY)) == ["t0", "t2"]


def test_volume_is_filled_and_reported(dirty):
    assert ids(cleaning.missing_volume_rows(dirty)) == ["t0", "t3"]
    assert cleaning.fill_volume(dirty).filter("volume = 0").count() == 2
    assert quality.null_counts(dirty).first()["volume_missing"] == 2


def test_cleaning_twice_changes_nothing(spark):
    from checks import fixtures as fx

    once = cleaning.clean(fx.ticks(spark, SMALL))
    assert once.count() == cleaning.clean(once).count()
    assert quality.duplicate_groups(once, cleaning.TICKER_COPY).count() == 0


def test_leading_rows_are_picked_before_the_shuffle(dirty):
    plan = cleaning.drop_copies(dirty)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_keys_and_references(spark, dirty):
    bad = quality.primary_key_violations(dirty.withColumn("day", F.col("date").cast("string")), "day", "prices")
    assert [tuple(r) for r in bad.collect()] == [("prices", "day", "2020-01-01", 4)]
    assert quality.primary_key_violations(dirty, "transaction_id", "prices").count() == 0
    parents = dirty.filter("stock_id = 'a'")
    orphans = quality.foreign_key_violations(dirty, parents, s.TICKER, "r").collect()
    assert [tuple(r) for r in orphans] == [("r", "b|B", 1)]


def test_summary(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, None)], "x double, y bigint")
    rows = {r.column_name: r for r in quality.summary_stats(df, ["x", "y"]).collect()}
    assert (rows["x"]["count"], rows["x"]["mean"], rows["x"]["max"]) == (2.0, 2.0, 3.0)
    assert abs(rows["x"]["stddev"] - 2**0.5) < 1e-12
    assert rows["y"]["count"] == 1 and rows["y"]["stddev"] is None
