from __future__ import annotations

import random

import pytest

from conftest import same
from quotewright import schemas as s
from quotewright.operators import chunks, history, indicators
from quotewright.operators.changes import nested_watchlists
from quotewright.plans.indicators import technical_frame
from quotewright.sources.storage import fresh_path, shared_dir


@pytest.fixture(autouse=True)
def many_tasks(monkeypatch):
    """Short pieces in tasks of their own, so that they meet at borders."""
    monkeypatch.setattr(chunks, "MIN_TASK_ROWS", 1)


@pytest.fixture
def skewed(series):
    """One ticker with many times the bars of the others."""
    rng = random.Random(1)

    def walk(n):
        return [round(rng.uniform(50, 150), 2) for _ in range(n)]

    return series(hot=walk(1500), a=walk(260), b=walk(5), c=walk(1))


@pytest.mark.parametrize("max_rows", [200, 333])
def test_pieces_give_the_values_of_the_whole(skewed, max_rows):
    assert same(technical_frame(skewed), technical_frame(skewed, max_rows=max_rows))


def test_single_operators_in_pieces(skewed):
    for operator in (indicators.sma, indicators.ema, indicators.rolling_stddev, indicators.rsi):
        assert same(operator(skewed, [5, 20]), operator(skewed, [5, 20], max_rows=50))
    assert same(indicators.price_change(skewed), indicators.price_change(skewed, max_rows=7))


def test_only_oversized_tickers_are_cut(skewed):
    split = chunks.split_oversized(skewed, s.TICKER, 300)
    assert {r.stock_id for r in split.hot.select("stock_id").distinct().collect()} == {"hot"}
    assert split.hot_rows == 1500 and split.whole.count() == split.whole_rows == 266
    split = chunks.split_oversized(skewed, s.TICKER, 1500)
    assert split.hot is None and split.whole is skewed and split.whole_rows == 1766


def test_pieces_are_full_and_carry_their_lookback(skewed):
    split = chunks.split_oversized(skewed, s.TICKER, 300)
    placed = chunks.chunked(split.hot, split.hot_rows, s.TICKER, s.ORDER, 300, lookback=20).cache()
    sizes = placed.filter("not _warm").groupBy("_chunk").count().collect()
    assert {r["_chunk"]: r["count"] for r in sizes} == dict.fromkeys(range(5), 300)
    for row in placed.filter("_warm").groupBy("_chunk").count().collect():
        assert row["count"] == 20
    with pytest.raises(ValueError):
        chunks.chunked(split.hot, split.hot_rows, s.TICKER, s.ORDER, 10, lookback=20)


def test_many_bars_on_one_day_are_cut_too(spark, series):
    day = [c if c != "date" else "date'2020-01-01' as date" for c in s.PRICES.fieldNames()]
    bars = series(a=[float(i) for i in range(100)]).selectExpr(*day)
    assert same(indicators.sma(bars, [3]), indicators.sma(bars, [3], max_rows=10))


def test_missing_keys_form_a_group_of_their_own(series):
    bars = series(a=[float(i) for i in range(40)]).selectExpr(
        *[c if c != "ticker_symbol" else "cast(null as string) as ticker_symbol" for c in s.PRICES.fieldNames()]
    )
    assert same(indicators.sma(bars, [3]), indicators.sma(bars, [3], max_rows=10))


def test_long_lists_span_pages(skewed):
    nested = history.nested_bars(skewed, max_rows=400).collect()
    pages = {(r.stock_id, r.page): [b.transaction_id for b in r.bars] for r in nested}
    assert sorted(p for stock, p in pages if stock == "hot") == [0, 1, 2, 3]
    assert sorted(p for stock, p in pages if stock == "a") == [0]
    joined = [i for page in range(4) for i in pages["hot", page]]
    assert joined == [f"hot:{i:05d}" for i in range(1500)]


def test_long_watchlists_span_pages(spark):
    lists = spark.createDataFrame([("w1", 1, "x"), ("w2", 1, "y"), ("w3", 2, "z")], s.WATCHLISTS)
    members = spark.createDataFrame(
        [("w1", f"{i:03d}", f"T{i}") for i in range(25)] + [("w2", "007", "T7")], s.MEMBERS
    )
    rows = nested_watchlists(lists, members, max_rows=10).collect()
    sizes = sorted((r.watchlist_id, r.page, len(r.stocks)) for r in rows)
    assert sizes == [("w1", 0, 10), ("w1", 1, 10), ("w1", 2, 5), ("w2", 0, 1), ("w3", 0, 0)]


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert fresh_path(spark, "x").startswith(folder) and fresh_path(spark, "x") != fresh_path(spark, "x")
