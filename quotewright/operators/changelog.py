"""Watchlist changes of all kinds applied in their order, as one batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotewright.sources import writers

# One change: its place in the order, what it does, to which list, and who asks for it.
CHANGES = "seq long, op string, watchlist_id string, user_id long, watchlist_name string, stock_id string, ticker_symbol string"
CREATE, RENAME, DELETE, ADD, DROP = "create", "rename", "delete", "add", "drop"


def applied_changes(lists: DataFrame, changes: DataFrame) -> DataFrame:
    """Those changes that take effect, with ``life``: how often the list was created until then.

    A list that is not there can only be created, by anyone; one that is can be renamed,
    deleted and given or rid of members by its owner alone.  ``lists`` is what is there before.
    Rows are streamed by list and order with the owner as the only state, so a list
    with very many changes takes time but no memory.  Changes without a list or a place in
    the order have no effect.
    """
    start = lists.select(
        F.lit(None).cast("long").alias("seq"), F.lit(CREATE).alias("op"), "watchlist_id", "user_id", "watchlist_name",
        F.lit(None).cast("string").alias("stock_id"), F.lit(None).cast("string").alias("ticker_symbol"),
    )
    create, delete = CREATE, DELETE

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, owner, life = None, None, 0
        for batch in batches:
            keep, lives = [], []
            columns = (batch.column(c).to_pylist() for c in ("watchlist_id", "op", "user_id"))
            for k, (watchlist, op, user) in enumerate(zip(*columns, strict=True)):
                if watchlist != name:
                    name, owner, life = watchlist, None, 0
                if user is None or (op == create) != (owner is None) or owner not in (None, user):
                    continue
                if op == create:
                    owner, life = user, life + 1
                elif op == delete:
                    owner = None
                keep.append(k)
                lives.append(life)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(lives, pa.int64())], names=[*kept.schema.names, "life"])

    given = changes.select(*start.columns).filter("watchlist_id is not null and seq is not null")
    ordered = start.unionByName(given).repartition("watchlist_id").sortWithinPartitions("watchlist_id", F.asc_nulls_first("seq"))
    return ordered.mapInArrow(follow, f"{CHANGES}, life long")


def apply_changes(lists: DataFrame, members: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists and members after all changes, one after another.

    The changes that take effect are compacted: a list's last creation or deletion says whether it
    is there, its last name is its name, and a member's last addition or removal in the
    list's present life says whether it is one.  Places in the order should be unique.
    """
    done = writers.persisted(applied_changes(lists, changes), "applied_changes")
    order = F.coalesce("seq", F.lit(-(1 << 62)))
    own = F.struct("life", order)
    of = lambda *ops: F.col("op").isin(*ops)
    states = done.filter(of(CREATE, DELETE, RENAME)).groupBy("watchlist_id").agg(
        F.max_by("op", F.when(of(CREATE, DELETE), own)).alias("_last"),
        F.max_by("user_id", F.when(of(CREATE), own)).alias("user_id"),
        F.max_by("watchlist_name", F.when(of(CREATE, RENAME), own)).alias("watchlist_name"),
        F.max("life").alias("_life"),
    )
    alive = writers.persisted(states.filter(F.col("_last") == CREATE).drop("_last"), "lists_after")
    first = members.select("watchlist_id", "stock_id", "ticker_symbol").withColumns({"life": F.lit(1), "_place": F.lit(-(1 << 62)), "op": F.lit(ADD)})
    later = done.filter(of(ADD, DROP)).select("watchlist_id", "stock_id", "ticker_symbol", "life", order.alias("_place"), "op")
    last = first.unionByName(later).groupBy("watchlist_id", "stock_id").agg(
        F.max_by(F.struct("op", "ticker_symbol", "life"), F.struct("life", "_place")).alias("_last")
    )
    held = last.filter(F.col("_last.op") == ADD).join(alive.select("watchlist_id", "_life"), "watchlist_id")
    held = held.filter(F.col("_last.life") == F.col("_life"))
    return (
        alive.select("watchlist_id", "user_id", "watchlist_name"),
        held.select("watchlist_id", "stock_id", F.col("_last.ticker_symbol").alias("ticker_symbol")),
    )
