"""The wide technical frame, its three tables, and the join that rebuilds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotewright import schemas as s
from quotewright.functions.dates import Bound, as_date, in_range


def _named(df: DataFrame, names: dict[str, str]) -> list:
    """Select columns ``names.values()`` of ``df`` under ``names.keys()``."""
    return [F.col(f"`{source}`").alias(name) for name, source in names.items()]


def moving_averages_of(wide: DataFrame) -> DataFrame:
    return s.conform(wide.select(*s.KEYS, *_named(wide, s.WIDE_MA)), s.MOVING_AVERAGES)


def bands_of(wide: DataFrame) -> DataFrame:
    return s.conform(wide.select(*s.KEYS, *_named(wide, s.WIDE_BANDS)), s.BANDS)


def rsi_of(wide: DataFrame) -> DataFrame:
    return s.conform(wide.select(*s.KEYS, *[f"`{c}`" for c in s.RSI_COLUMNS]), s.RSI)


def technical_join(
    prices: DataFrame,
    averages: DataFrame,
    bands: DataFrame,
    strength: DataFrame,
    start: Bound = None,
    end: Bound = None,
    on: Sequence[str] = ("stock_id", "date"),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Prices with all stored indicators, inner-joined on ``on``; ``extra`` price columns are kept.

    Where prices may hold several rows per stock and date, ``on=ROW_KEY`` pairs each with
    its own indicators only, and tables bucketed by that key still join in place.  The
    range is applied to every input, since each side is joined on the date it is filtered by.
    """
    on = list(on)
    within = in_range(F.col("date"), start, end)

    def side(table: DataFrame, columns: list) -> DataFrame:
        return table.filter(within).select(*on, *columns)

    ma = side(averages, [F.col(f"`{c}`").alias(w) for c, w in s.WIDE_MA.items()])
    bb = side(bands, [F.col(f"`{c}`").alias(w) for c, w in s.WIDE_BANDS.items()])
    ri = side(strength, [f"`{c}`" for c in s.RSI_COLUMNS])
    base = prices.filter(within).select(*dict.fromkeys([*on, "stock_id", "ticker_symbol", "date", "close", *extra]))
    joined = base.join(ma, on).join(bb, on).join(ri, on)
    return joined.select(*[f"`{c}`" for c in [*extra, *s.VIEW_COLUMNS]])


def view_range(as_of: Bound, days: int = s.VIEW_DAYS):
    """First and last date of the technical view built at ``as_of``."""
    last = as_date(as_of)
    return F.date_sub(last, days), last


def technical_view(
    prices: DataFrame, averages: DataFrame, bands: DataFrame, strength: DataFrame, as_of: Bound
) -> DataFrame:
    """The join of rows by their key over the view's horizon, bounds taken from ``as_of``."""
    start, end = view_range(as_of)
    return technical_join(prices, averages, bands, strength, start=start, end=end, on=s.ROW_KEY)


def view_of(wide: DataFrame, as_of: Bound) -> DataFrame:
    """The same rows from the wide frame, which holds all of the view's columns."""
    start, end = view_range(as_of)
    return wide.filter(in_range(F.col("date"), start, end)).select(*[f"`{c}`" for c in s.VIEW_COLUMNS])
