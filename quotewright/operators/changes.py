"""Batches of changes applied to keyed tables: table and changes in, new table out."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quotewright import schemas as s
from quotewright.operators.chunks import pages
from quotewright.sources import writers


def remove(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose key is not listed; missing values of a key match each other."""
    listed = keys.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(on)])
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(on)])
    return table.join(listed, same, "left_anti").select(*[f"`{c}`" for c in table.columns])


def one_each(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key: the first in the order of the remaining columns, nulls first."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in on]
    rank = F.row_number().over(Window.partitionBy(*on).orderBy(*(rest or [F.lit(0)])))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(table: DataFrame, changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Insert new keys and replace the rows of known ones; a key given twice counts once."""
    return remove(table, changes, on).unionByName(one_each(changes.select(*table.columns), on))


def add_new(table: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Append those ``rows`` whose key is not there yet; known keys stay untouched."""
    return table.unionByName(one_each(remove(rows.select(*table.columns), table, on), on))


def cascade_delete(child: DataFrame, deleted: DataFrame, on: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Drop child rows whose parent was deleted."""
    return remove(child, deleted, on)


def update_coverage(coverage: DataFrame, view_name: str, start: Column, end: Column) -> DataFrame:
    """Record the interval a view was built for, replacing an earlier record."""
    row = coverage.sparkSession.range(1).select(
        F.lit(view_name).alias("view_name"), start.alias("start_date"), end.alias("end_date")
    )
    return upsert(coverage, row, ["view_name"])


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """The saved record; empty before its first save."""
    try:
        return spark.read.schema(s.COVERAGE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], s.COVERAGE)


def save_coverage(coverage: DataFrame, path: str) -> None:
    """Replace the saved record, which the new one may have been made from."""
    writers.overwrite(writers.persisted(coverage, "coverage"), path, s.COVERAGE)


def coverage_of(coverage: DataFrame, view_name: str) -> DataFrame:
    """The recorded interval of one view; no row if it was never built."""
    return coverage.filter(F.col("view_name") == view_name).select("start_date", "end_date")


# Watchlists: lists(watchlist_id, user_id, watchlist_name), members(watchlist_id, stock_id, ticker_symbol).

LIST_KEY = ["watchlist_id"]
MEMBER_KEY = ["watchlist_id", "stock_id"]


def nested_watchlists(lists: DataFrame, members: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Lists with their stocks as an array; empty for a list without members.

    ``page`` is part of the key: a member's place in its list's order divided by
    ``max_rows``, so no row grows without bound.
    """
    order = [c for c in members.columns if c not in LIST_KEY]
    paged = pages(members, LIST_KEY, order, max_rows)
    stock = F.struct("stock_id", "ticker_symbol")
    stocks = paged.groupBy(*LIST_KEY, "page").agg(F.sort_array(F.collect_list(stock)).alias("stocks"))
    empty = F.array().cast("array<struct<stock_id:string,ticker_symbol:string>>")
    joined = lists.join(stocks, LIST_KEY, "left")
    return joined.select(
        "watchlist_id",
        "user_id",
        "watchlist_name",
        F.coalesce("page", F.lit(0)).cast("long").alias("page"),
        F.coalesce("stocks", empty).alias("stocks"),
    )


def find_watchlists(lists: DataFrame, wanted: DataFrame, on: Sequence[str] = ("user_id", "watchlist_name")) -> DataFrame:
    """Lists matching any of the wanted keys: by user and name, or by id."""
    return lists.join(wanted.select(*on), list(on), "left_semi").select(*lists.columns)


def add_to_watchlists(
    lists: DataFrame, members: DataFrame, additions: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Add stocks to users' lists, creating a list that is not there yet.

    ``additions`` has user_id, watchlist_name, stock_id, ticker_symbol and the
    ``watchlist_id`` to use if the list is new.
    """
    named = ["user_id", "watchlist_name"]
    wanted = additions.groupBy(*named).agg(F.min("watchlist_id").alias("watchlist_id"))
    all_lists = add_new(lists, wanted, named)
    resolved = additions.drop("watchlist_id").join(all_lists, named)
    return all_lists, add_new(members, resolved.select(*members.columns), MEMBER_KEY)


def delete_watchlists(lists: DataFrame, members: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete lists and, with them, their members."""
    return remove(lists, ids, LIST_KEY), cascade_delete(members, ids, LIST_KEY)


def owned_changes(lists: DataFrame, changes: DataFrame) -> DataFrame:
    """Only those changes whose requester owns the list."""
    return changes.join(lists.select("watchlist_id", "user_id"), ["watchlist_id", "user_id"], "left_semi").select(
        *changes.columns
    )


def rename_watchlists(lists: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply new names (watchlist_id, user_id, new_name) asked for by the owner."""
    names = owned_changes(lists, changes).groupBy("watchlist_id").agg(F.max("new_name").alias("new_name"))
    renamed = lists.join(names, LIST_KEY, "left")
    return renamed.withColumn("watchlist_name", F.coalesce("new_name", "watchlist_name")).select(*lists.columns)


def replace_members(
    members: DataFrame, ids: DataFrame, replacement: DataFrame, lists: DataFrame | None = None
) -> DataFrame:
    """Replace all members of the lists in ``ids``; a list without new rows ends up empty.

    With ``lists``, ``ids`` also name the requesting user_id, and only lists that this user
    owns change.  A member given twice is stored once.
    """
    if lists is not None:
        ids = owned_changes(lists, ids)
    kept = remove(members, ids, LIST_KEY)
    added = replacement.join(ids.select(*LIST_KEY), LIST_KEY, "left_semi")
    return kept.unionByName(one_each(added.select(*members.columns), MEMBER_KEY))
