"""Cleaning of price rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows that repeat a ticker's date and close are copies.
TICKER_COPY = ["stock_id", "ticker_symbol", "date", "close"]
GLOBAL_COPY = ["date", "close"]


def fill_volume(df: DataFrame) -> DataFrame:
    """A missing volume counts as 0."""
    return df.na.fill(0, subset=["volume"])


def missing_volume_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("volume").isNull())


def drop_copies(
    df: DataFrame, keys: Sequence[str] = TICKER_COPY, tie_break: Sequence[str | Column] = ("transaction_id",)
) -> DataFrame:
    """Keep one row per key: the first in ``tie_break`` order.

    Spark keeps only the leading row of each key map-side before it shuffles, so a
    key with very many copies costs each task one row.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*tie_break))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def clean(df: DataFrame, keys: Sequence[str] = TICKER_COPY, first: Sequence[Column] = ()) -> DataFrame:
    """Fill volumes, then drop copies; ``first`` goes before the id in choosing the copy that stays."""
    return drop_copies(fill_volume(df), keys, [*first, "transaction_id"])
