"""Reads of stored prices and indicators.

``stocks`` is a DataFrame of the keys wanted, one row or many; ``None`` reads all.
The key set joins as a semi-join, so one request and a million cost one pass.
Results are unordered; ``ordered`` sorts where a caller presents them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quotewright import schemas as s
from quotewright.functions.dates import Bound, as_date, in_range
from quotewright.operators.chunks import CHUNK, MAX_ROWS, chunked, pages, split_oversized


def of_stocks(df: DataFrame, stocks: DataFrame | None, keys: Sequence[str] = s.TICKER) -> DataFrame:
    if stocks is None:
        return df
    return df.join(stocks.select(*keys), list(keys), "left_semi").select(*df.columns)


def of_stock(df: DataFrame, stock_id: str, ticker_symbol: str | None = None) -> DataFrame:
    """One stock by literal key; the filter reaches the scan."""
    found = df.filter(F.col("stock_id") == stock_id)
    return found if ticker_symbol is None else found.filter(F.col("ticker_symbol") == ticker_symbol)


def ordered(df: DataFrame, order: str = "asc", keys: Sequence[str] = s.TICKER) -> DataFrame:
    """Sort by stock and date; a range sort, so it spreads like any other shuffle."""
    if order not in ("asc", "desc"):
        raise ValueError(f"order must be 'asc' or 'desc', not {order!r}")
    day = F.asc("date") if order == "asc" else F.desc("date")
    return df.orderBy(*keys, day)


def price_history(prices: DataFrame, stocks: DataFrame | None = None) -> DataFrame:
    return of_stocks(prices, stocks).select("transaction_id", "date", "low", "open", "high", "volume", "close")


def prices_in_range(
    prices: DataFrame, stocks: DataFrame | None = None, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Price rows inside the closed interval; either bound may be missing."""
    wanted = of_stocks(prices, stocks).filter(in_range(F.col("date"), start, end))
    return wanted.select("transaction_id", "stock_id", "ticker_symbol", "date", "close", "volume")


def date_range_filter(df: DataFrame, start: Bound, end: Bound) -> DataFrame:
    return df.filter(in_range(F.col("date"), start, end))


def ids_and_dates(prices: DataFrame, stocks: DataFrame | None = None) -> DataFrame:
    return of_stocks(prices, stocks).select("transaction_id", "date")


def read_indicators(table: DataFrame, columns: Sequence[str], stocks: DataFrame | None = None) -> DataFrame:
    """Rows of one stored indicator table."""
    return of_stocks(table, stocks).select("stock_id", "ticker_symbol", "date", *columns)


def technical_from_view(
    view: DataFrame, stocks: DataFrame | None = None, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Indicator rows of the view inside the closed interval.

    A saved view is bounded by ``year`` too, so that other years' folders aren't opened.
    """
    inside = in_range(F.col("date"), start, end)
    if "year" in view.columns:
        years = [None if bound is None else F.year(as_date(bound)) for bound in (start, end)]
        for bound, within in zip(years, (F.col("year").__ge__, F.col("year").__le__), strict=True):
            inside = inside if bound is None else inside & within(bound)
    return of_stocks(view.filter(inside), stocks, ["stock_id"]).select(*[f"`{c}`" for c in s.VIEW_COLUMNS])


def present_in(stocks: DataFrame, table: DataFrame, keys: Sequence[str] = s.TICKER) -> DataFrame:
    """Those of ``stocks`` that have at least one row in ``table``."""
    return stocks.join(table.select(*keys).distinct(), list(keys), "left_semi").select(*stocks.columns)


def distinct_stocks(prices: DataFrame) -> DataFrame:
    return prices.select(*s.TICKER).distinct()


def latest_per_ticker(prices: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` bars of every ticker.

    Up to ``GROUP_LIMIT`` each task forwards at most ``n`` bars of a ticker.  Beyond it Spark
    forwards all, so tickers with more than a million bars are cut into pieces of ``n``
    by time first, and only their last two pieces are ranked.
    """
    if n <= GROUP_LIMIT:
        return _newest(prices, n)
    split = split_oversized(prices, ["ticker_symbol"], max(n, MAX_ROWS))
    result = _newest(split.whole, n)
    if split.hot is None:
        return result
    pieces = chunked(split.hot, split.hot_rows, ["ticker_symbol"], s.ORDER, n)
    last = pieces.groupBy("ticker_symbol").agg(F.max(CHUNK).alias("_last"))
    last = last.withColumnRenamed("ticker_symbol", "_ticker")
    kept = pieces.join(last, F.col("ticker_symbol").eqNullSafe(F.col("_ticker")) & (F.col(CHUNK) >= F.col("_last") - 1))
    return result.unionByName(_newest(kept.select(*prices.columns), n))


# Spark's own threshold: up to this rank a window is cut before its rows are shuffled.
GROUP_LIMIT = 1000


def _newest(prices: DataFrame, n: int) -> DataFrame:
    newest = Window.partitionBy("ticker_symbol").orderBy(F.desc("date"), F.desc("transaction_id"))
    ranked = prices.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n)
    return ranked.drop("_rank")


def latest_n(prices: DataFrame, n: int = 200) -> DataFrame:
    """The newest ``n`` rows overall."""
    return prices.orderBy(F.desc("date"), F.desc("transaction_id")).limit(n)


def staleness(companies: DataFrame, prices: DataFrame, as_of: Bound) -> DataFrame:
    """Newest stored date per company and its age in days at ``as_of``; NULL if none."""
    newest = prices.groupBy(*s.TICKER).agg(F.max("date").alias("latest_date"))
    joined = companies.select(*s.TICKER).join(newest, s.TICKER, "left")
    return joined.withColumn("days_stale", F.datediff(as_date(as_of), F.col("latest_date")))


def nested_bars(prices: DataFrame, max_rows: int = 10_000, bounded: bool = False) -> DataFrame:
    """One row per ticker with its bars as a date-ordered array.

    ``page`` is part of the key: a bar's place in its ticker's order divided by
    ``max_rows``, so no row grows without bound.  ``bounded`` says that no ticker is oversized.
    """
    paged = pages(prices, s.TICKER, s.ORDER, max_rows, bounded=bounded)
    bar = F.struct("date", "transaction_id", "low", "open", "high", "volume", "close")
    return paged.groupBy(*s.TICKER, "page").agg(F.sort_array(F.collect_list(bar)).alias("bars"))


def union_tickers(*frames: DataFrame) -> DataFrame:
    """Bag union of price frames, matched by column name."""
    columns = s.PRICES.fieldNames()
    result = frames[0].select(*columns)
    for frame in frames[1:]:
        result = result.unionByName(frame.select(*columns))
    return result


# Chart columns and the wide columns they show.
CHART = {
    "date": "date",
    "close": "close",
    "20_ema": "ma_20_days_ema",
    "50_sma": "ma_50_days_sma",
    "200_sma": "ma_200_days_sma",
    "50_ema": "ma_50_days_ema",
    "200_ema": "ma_200_days_ema",
    "20_lower_band": "bb_20_lower_band",
    "20_upper_band": "bb_20_upper_band",
    "20_days_rsi": "20_days_rsi",
}


def chart_frame(technical: DataFrame, keep: Sequence[str] = ("stock_id",)) -> DataFrame:
    """The columns a technical chart plots, under its own names."""
    shown = [F.col(f"`{source}`").alias(name) for name, source in CHART.items()]
    return technical.select(*keep, *shown)


def close_series(prices: DataFrame) -> DataFrame:
    return prices.select("stock_id", "date", F.col("close").alias("close_prices"))
