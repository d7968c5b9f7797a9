"""From raw price rows to the wide technical frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from quotewright import schemas as s
from quotewright.functions.dates import Bound, in_range
from quotewright.operators.chunks import MAX_ROWS, compute_in_pieces, split_oversized
from quotewright.operators.cleaning import clean
from quotewright.operators.indicators import lookback, technical_columns


def technical_frame(
    prices: DataFrame,
    start: Bound = None,
    end: Bound = None,
    max_rows: int = MAX_ROWS,
    sized_by: DataFrame | None = None,
    cleaned: bool = False,
    placed: bool = False,
    wanted: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    families: Sequence[str] = s.FAMILIES,
    marks: Sequence[str] = (),
) -> DataFrame:
    """Clean, compute every indicator, then apply the closed date range.

    The frames read bars before ``start``, so the range is applied last.  Rows are
    shuffled by ticker once: copies of a bar and the frames over them both live
    inside a ticker.  The partition count is explicit, as configured or as the row
    count asks for, because the work per byte is high: partitions merged by size
    would idle most of the cores, and too few would outgrow a task.  Tickers too
    big for a task are deduplicated by their finer key and computed in pieces;
    ``sized_by`` may name a table that is cheaper to count and bounds ``prices``;
    ``cleaned`` says that ``prices`` are clean already; ``placed`` that besides every ticker is in
    one partition, none of them oversized, so that nothing is counted or shuffled.  ``wanted`` adds a
    column ``_wanted``, given the rows and the windows' keys: other rows serve the frames only.
    Only the columns of ``families`` are computed.  Columns ``marks`` of the rows are kept, behind the others; of
    copies of a bar the one with the larger marks stays.
    """

    def compute(rows: DataFrame, keys: list[str]) -> DataFrame:
        if wanted is None:
            return technical_columns(rows, keys, families)
        return technical_columns(wanted(rows, keys), keys, families).filter("_wanted")

    def tidy(rows: DataFrame) -> DataFrame:
        return rows if cleaned else clean(rows, first=[F.desc(m) for m in marks if m in rows.columns])

    if placed:
        return _presented(compute(tidy(prices), s.TICKER), start, end, families, marks)
    split = split_oversized(prices, s.TICKER, max_rows, sized_by)
    configured = int(prices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(configured, -(-split.whole_rows // max_rows))
    wide = compute(tidy(split.whole.repartition(tasks, *s.TICKER)), s.TICKER)
    if split.hot is not None:
        pieces = compute_in_pieces(
            tidy(split.hot), split.hot_rows, compute, lookback(), max_rows=max_rows
        )
        wide = wide.unionByName(pieces)
    return _presented(wide, start, end, families, marks)


def _presented(wide: DataFrame, start: Bound, end: Bound, families: Sequence[str], marks: Sequence[str]) -> DataFrame:
    wide = wide.withColumn("cal_id", F.col("transaction_id"))
    wide = wide.select(*s.KEYS, "close", *[f"`{c}`" for c in s.columns_of(families)], *marks)
    if start is None or end is None:
        return wide
    return wide.filter(in_range(F.col("date"), start, end))
