"""Joins of closed date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotewright.functions.dates import overlaps

BUCKET_DAYS = 366
EPOCH = "1970-01-01"


def _span(df: DataFrame, range_: Sequence[str]) -> DataFrame:
    """Least and greatest bound of the ranges, one row."""
    start, end = (F.col(c).cast("date") for c in range_)
    return df.agg(F.least(F.min(start), F.min(end)).alias("low"), F.greatest(F.max(start), F.max(end)).alias("high"))


def _bucketed(df: DataFrame, keys: Sequence[str], range_: Sequence[str], days: int, span: tuple, tag: str) -> DataFrame:
    """Each row once per bucket of its range, as (_key.., _{tag}, _{tag}_first, _bucket).

    A missing bound is as far out as any; a range that ends before it starts has no bucket.
    """
    low, high = (F.lit(x).cast("date") for x in span)
    start, end = F.coalesce(F.col(range_[0]), low), F.coalesce(F.col(range_[1]), high)
    number = lambda day: F.floor(F.datediff(F.greatest(F.least(day, high), low), F.lit(EPOCH).cast("date")) / days)
    inside = df.filter((start <= end) & (start <= high) & (end >= low))
    return inside.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.struct(*[f"`{c}`" for c in df.columns]).alias(f"_{tag}"),
        start.alias(f"_{tag}_start"),
        end.alias(f"_{tag}_end"),
        number(start).alias(f"_{tag}_first"),
        F.explode(F.sequence(number(start), number(end))).alias("_bucket"),
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_range: Sequence[str] = ("start_date", "end_date"),
    right_range: Sequence[str] = ("first_date", "last_date"),
    days: int = BUCKET_DAYS,
) -> DataFrame:
    """Pairs of rows with equal keys whose closed ranges share a day, as ``_left`` and ``_right``
    structs with ``overlap_start`` and ``overlap_end``.

    Both sides are dealt into buckets of ``days`` days and joined by key and bucket, so a
    key with very many ranges is spread over its buckets, and rows that are years apart
    never meet.  A pair meets in every bucket that both ranges touch and is kept in the first.
    A missing bound leaves that side of a range open: it reaches as far as any bound of
    either input.  Rows with a missing key have no partner.  Long ranges cost a row per bucket,
    so choose buckets about as long as a usual range.
    """
    bounds = _span(left, left_range).unionByName(_span(right, right_range))
    span = bounds.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    span = tuple(x or EPOCH for x in (span["low"], span["high"]))  # only open ranges: any day will do
    one = _bucketed(left, keys, left_range, days, span, "left")
    other = _bucketed(right, keys, right_range, days, span, "right")
    both = one.join(other, [*[f"_key{i}" for i in range(len(keys))], "_bucket"])
    first = F.col("_bucket") == F.greatest("_left_first", "_right_first")
    shared = overlaps(F.col("_left_start"), F.col("_left_end"), F.col("_right_start"), F.col("_right_end"))
    return both.filter(first & shared).select(
        "_left",
        "_right",
        F.greatest("_left_start", "_right_start").alias("overlap_start"),
        F.least("_left_end", "_right_end").alias("overlap_end"),
    )
