from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotewright import schemas as s
from quotewright.functions.dates import overlaps
from quotewright.operators import history, technical
from quotewright.plans.indicators import technical_frame


def stock(spark, *names):
    return spark.createDataFrame([(n, n.upper()) for n in names], "stock_id string, ticker_symbol string")


def test_reads_of_one_stock(spark, series):
    bars = series(a=[1.0, 2.0, 3.0], b=[4.0])
    assert [r.close for r in history.ordered(history.of_stock(bars, "a", "A")).collect()] == [1.0, 2.0, 3.0]
    newest_first = history.ordered(history.of_stock(bars, "a"), "desc").collect()
    assert [r.close for r in newest_first] == [3.0, 2.0, 1.0]
    assert history.price_history(bars, stock(spark, "b")).first().close == 4.0
    assert history.ids_and_dates(bars, stock(spark, "a")).count() == 3
    with pytest.raises(ValueError):
        history.ordered(bars, "down")


def test_ranges_are_closed_and_may_be_open_ended(series):
    bars = series(a=[1.0, 2.0, 3.0, 4.0])

    def closes(start=None, end=None):
        return sorted(r.close for r in history.prices_in_range(bars, None, start, end).collect())

    assert closes("2020-01-02", "2020-01-03") == [2.0, 3.0]
    assert closes("2020-01-03") == [3.0, 4.0]
    assert closes(end=dt.date(2020, 1, 1)) == [1.0]
    assert closes() == [1.0, 2.0, 3.0, 4.0]


def test_presence_and_distinct(spark, series):
    bars = series(a=[1.0, 2.0], b=[4.0])
    assert [r.stock_id for r in history.present_in(stock(spark, "a", "z"), bars).collect()] == ["a"]
    assert history.distinct_stocks(bars).count() == 2


def test_latest(series):
    bars = series(a=[1.0, 2.0, 3.0], b=[4.0])
    assert sorted(r.close for r in history.latest_per_ticker(bars).collect()) == [3.0, 4.0]
    assert sorted(r.close for r in history.latest_per_ticker(bars, 2).collect()) == [2.0, 3.0, 4.0]
    assert [r.close for r in history.latest_n(bars, 2).collect()] == [3.0, 2.0]


def test_staleness(spark, series):
    rows = history.staleness(stock(spark, "a", "z"), series(a=[1.0, 2.0]), "2020-01-12").collect()
    assert {r.stock_id: r.days_stale for r in rows} == {"a": 10, "z": None}


def test_overlap_of_closed_intervals(spark):
    cases = [
        ("2020-01-01", "2020-01-10", "2020-01-10", "2020-02-01", True),
        ("2020-01-01", "2020-01-09", "2020-01-10", "2020-02-01", False),
        ("2020-01-05", "2020-01-06", "2020-01-01", "2020-02-01", True),
        ("2020-13-01", "2020-01-06", "2020-01-01", "2020-02-01", False),
        (None, "2020-01-06", "2020-01-01", "2020-02-01", False),
    ]
    df = spark.createDataFrame(cases, "a string, b string, c string, d string, expected boolean")
    found = df.select(overlaps(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("o"), "expected").collect()
    assert all(r.o is r.expected for r in found)


def test_tables_and_their_join_rebuild_the_wide_frame(series):
    bars = series(a=[1.0, 2.0, 3.0], b=[4.0, 1.0])
    wide = technical_frame(bars)
    tables = technical.moving_averages_of(wide), technical.bands_of(wide), technical.rsi_of(wide)
    assert [t.schema for t in tables] == [s.MOVING_AVERAGES, s.BANDS, s.RSI]
    joined = technical.technical_join(bars, *tables)
    assert joined.columns == s.VIEW_COLUMNS
    assert joined.exceptAll(wide.select(*joined.columns)).count() == 0 and joined.count() == 5


def test_join_on_ids_does_not_pair_bars_of_one_day(series):
    day = [c if c != "date" else "date'2020-01-01' as date" for c in s.PRICES.fieldNames()]
    bars = series(a=[1.0, 2.0]).selectExpr(*day)
    wide = technical_frame(bars)
    tables = technical.moving_averages_of(wide), technical.bands_of(wide), technical.rsi_of(wide)
    assert technical.technical_join(bars, *tables).count() == 16
    assert technical.technical_join(bars, *tables, on=["transaction_id"]).count() == 2
    assert technical.technical_join(bars, *tables, on=s.ROW_KEY).count() == 2
    assert technical.technical_view(bars, *tables, as_of="2020-01-01").count() == 2
    assert technical.view_of(wide, "2020-01-01").count() == 2


def test_more_bars_than_the_group_limit(series, monkeypatch):
    bars = series(a=[float(i) for i in range(60)], b=[1.0])
    monkeypatch.setattr(history, "GROUP_LIMIT", 3)
    plain = sorted((r.stock_id, r.close) for r in history.latest_per_ticker(bars, 7).collect())
    monkeypatch.setattr(history, "MAX_ROWS", 10)
    found = history.latest_per_ticker(bars, 7)
    assert sorted((r.stock_id, r.close) for r in found.collect()) == plain == [*[("a", float(i)) for i in range(53, 60)], ("b", 1.0)]


def test_view_bounds_come_from_the_given_day(spark, series):
    bars = series(a=[float(i + 1) for i in range(20)])
    wide = technical_frame(bars)
    tables = technical.moving_averages_of(wide), technical.bands_of(wide), technical.rsi_of(wide)
    assert technical.technical_view(bars, *tables, as_of="2029-12-31").count() == 18
    assert technical.technical_view(bars, *tables, as_of="2020-01-05").count() == 5


def test_chart_columns(series):
    chart = history.chart_frame(technical_frame(series(a=[1.0])))
    assert chart.columns == ["stock_id", *history.CHART]
    assert history.close_series(series(a=[1.0])).first().close_prices == 1.0
