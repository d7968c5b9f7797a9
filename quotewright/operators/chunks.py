"""Bounded pieces of an ordered series, whatever the skew.

A window partitioned by ticker puts one ticker's whole history into one task.
That is right for daily bars, and fatal for a ticker that holds a third of all
rows.  ``per_ticker`` therefore counts rows per ticker first (a job that reads
two columns and combines map-side).  With no oversized ticker the plan is the
plain one-shuffle window.  Otherwise oversized tickers are range-partitioned by
time, cut into pieces of exactly ``max_rows`` bars, and each piece is handed the
few bars before it that its frames look back on.  The results are the same rows
and values either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotewright.schemas import ORDER, TICKER
from quotewright.sources.storage import shared_dir

# Bars of one series that one task windows over comfortably (minutes, not hours).
MAX_ROWS = 1_000_000
# Shorter pieces share a task.
MIN_TASK_ROWS = 100_000
# Largest key or offset table handed to every executor, in rows (well under 100 MB).
MAX_BROADCAST_ROWS = 200_000

CHUNK = "_chunk"


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only what was counted and is small; else leave the join to Spark."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


@dataclass(frozen=True)
class Split:
    """Rows of ordinary keys and, if there are any, of oversized ones, with row counts."""

    whole: DataFrame
    whole_rows: int
    hot: DataFrame | None = None
    hot_rows: int = 0


def _same_key(keys: Sequence[str]) -> Column:
    """Join condition against the ``_key0..`` columns; missing keys match each other."""
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return condition


def chunked(
    df: DataFrame, rows: int, keys: Sequence[str], order: Sequence[str], max_rows: int, lookback: int = 0
) -> DataFrame:
    """Add ``_chunk``: 0, 1, ... per ``max_rows`` consecutive rows of a key.

    With ``lookback`` the last rows of each piece also appear, flagged ``_warm``,
    in the next one.  The range partitioning balances on (keys, order), so a hot
    key is spread; the checkpoint pins that partitioning, so that the counts and
    the rows agree even if executors are lost in between.
    """
    if lookback > max_rows:
        raise ValueError("a piece must be at least as long as the look-back")
    shared_dir(df.sparkSession)
    tasks = max(1, -(-rows // max(max_rows, MIN_TASK_ROWS)))
    ranged = (
        df.repartitionByRange(tasks, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_seq", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    runs = ranged.groupBy(*keys, "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_in"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    ).checkpoint()
    joined = ranged.join(
        small_side(starts, starts.count()), _same_key(keys) & (F.col("_part") == F.col("_in"))
    )
    position = F.col("_seq") + F.col("_shift")
    chunk = F.floor(position / max_rows).cast("long")
    placed = joined.select(*df.columns, position.alias("_pos"), chunk.alias(CHUNK))
    if not lookback:
        return placed.drop("_pos")
    near_end = F.col("_pos") % max_rows >= max_rows - lookback
    targets = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        placed.withColumn("_ahead", F.explode(targets))
        .withColumn("_warm", F.col("_ahead") == 1)
        .withColumn(CHUNK, F.col(CHUNK) + F.col("_ahead"))
        .drop("_pos", "_ahead")
    )


def split_oversized(df: DataFrame, keys: Sequence[str], max_rows: int, sized_by: DataFrame | None = None) -> Split:
    """Set apart the keys with more than ``max_rows`` rows.

    ``sized_by`` names rows that are cheaper to count than ``df`` and at least as
    many per key, such as the table ``df`` was filtered from.  There are at most
    ``total / max_rows`` oversized keys; they are broadcast only if that is few.
    """
    counts = (df if sized_by is None else sized_by).groupBy(*keys).agg(F.count("*").alias("_rows"))
    is_hot = F.col("_rows") > max_rows
    found = counts.agg(
        F.count_if(is_hot).alias("keys"),
        F.coalesce(F.sum(F.when(is_hot, F.col("_rows"))), F.lit(0)).alias("hot"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
    ).first()
    if not found["keys"]:
        return Split(df, found["rows"])
    shared_dir(df.sparkSession)
    hot_keys = counts.filter(is_hot).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    side = small_side(hot_keys.checkpoint(), found["keys"])
    return Split(
        whole=df.join(side, _same_key(keys), "left_anti"),
        whole_rows=found["rows"] - found["hot"],
        hot=df.join(side, _same_key(keys), "left_semi"),
        hot_rows=found["hot"],
    )


def compute_in_pieces(
    rows: DataFrame,
    count: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    lookback: int,
    keys: Sequence[str] = TICKER,
    order: Sequence[str] = ORDER,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``compute`` over pieces of at most ``max_rows`` rows plus their look-back."""
    keys = list(keys)
    done = compute(chunked(rows, count, keys, list(order), max_rows, lookback), [*keys, CHUNK])
    return done.filter(~F.col("_warm")).drop("_warm", CHUNK)


def per_ticker(
    df: DataFrame,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    lookback: int,
    max_rows: int = MAX_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Run ``compute(rows, keys)``, whose frames reach ``lookback`` >= 1 bars back.

    ``sized_by`` names rows that are cheaper to count, as for ``split_oversized``.
    ``compute`` must partition its windows by the keys it is given, order them by
    date and id, and keep one row per input row.
    """
    split = split_oversized(df, TICKER, max_rows, sized_by)
    result = compute(split.whole, list(TICKER))
    if split.hot is None:
        return result
    return result.unionByName(compute_in_pieces(split.hot, split.hot_rows, compute, lookback, max_rows=max_rows))


def pages(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, task_rows: int = MAX_ROWS, bounded: bool = False
) -> DataFrame:
    """Add ``page``: a row's place in its key's order divided by ``max_rows``.

    Keys of at most ``task_rows`` rows are numbered by one window, whose shuffle also serves a
    grouping by key and page; only longer ones are cut by time first.  ``df`` is read once for
    the count and once for the rows, so save it if it is costly; ``bounded`` says that no key is longer, and nothing is counted.
    """
    keys, order = list(keys), list(order)
    split = Split(df, 0) if bounded else split_oversized(df, keys, max(max_rows, task_rows))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    whole = split.whole.withColumn("page", F.floor(place / max_rows).cast("long"))
    if split.hot is None:
        return whole
    pieces = chunked(split.hot, split.hot_rows, keys, order, max_rows)
    return whole.unionByName(pieces.withColumnRenamed(CHUNK, "page"))
