from __future__ import annotations

import datetime as dt
import random

import pytest

from quotewright import schemas as s
from quotewright.functions.dates import as_date
from quotewright.operators import changelog, changes


@pytest.fixture
def lists(spark):
    return spark.createDataFrame([("w1", 1, "tech"), ("w2", 1, "food"), ("w3", 2, "tech")], s.WATCHLISTS)


@pytest.fixture
def members(spark):
    return spark.createDataFrame([("w1", "2", "B"), ("w1", "1", "A"), ("w3", "1", "A")], s.MEMBERS)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_nested(lists, members):
    nested = {r.watchlist_id: [m.stock_id for m in r.stocks] for r in changes.nested_watchlists(lists, members).collect()}
    assert nested == {"w1": ["1", "2"], "w2": [], "w3": ["1"]}


def test_find(spark, lists):
    wanted = spark.createDataFrame([(1, "tech"), (2, "food")], "user_id bigint, watchlist_name string")
    assert rows(changes.find_watchlists(lists, wanted), "watchlist_id") == [("w1",)]
    by_id = spark.createDataFrame([("w2",), ("w2",)], "watchlist_id string")
    assert rows(changes.find_watchlists(lists, by_id, ["watchlist_id"]), "watchlist_id") == [("w2",)]


def test_add_creates_missing_lists_and_ignores_known_members(spark, lists, members):
    additions = spark.createDataFrame(
        [(1, "tech", "n1", "1", "A"), (1, "tech", "n2", "3", "C"), (2, "new", "n3", "1", "A"), (2, "new", "n4", "2", "B")],
        "user_id bigint, watchlist_name string, watchlist_id string, stock_id string, ticker_symbol string",
    )
    new_lists, new_members = changes.add_to_watchlists(lists, members, additions)
    assert rows(new_lists, "watchlist_id") == [("n3",), ("w1",), ("w2",), ("w3",)]
    assert rows(new_members, "watchlist_id", "stock_id") == [
        ("n3", "1"), ("n3", "2"), ("w1", "1"), ("w1", "2"), ("w1", "3"), ("w3", "1"),
    ]


def test_delete_cascades(spark, lists, members):
    left, kept = changes.delete_watchlists(lists, members, spark.createDataFrame([("w1",)], "watchlist_id string"))
    assert rows(left, "watchlist_id") == [("w2",), ("w3",)] and rows(kept) == [("w3", "1", "A")]


def test_only_owners_rename(spark, lists):
    asked = spark.createDataFrame(
        [("w1", 1, "IT"), ("w3", 1, "mine")], "watchlist_id string, user_id bigint, new_name string"
    )
    assert rows(changes.rename_watchlists(lists, asked), "watchlist_id", "watchlist_name") == [
        ("w1", "IT"), ("w2", "food"), ("w3", "tech"),
    ]


def test_replace(spark, members):
    ids = spark.createDataFrame([("w1",), ("w2",)], "watchlist_id string")
    new = spark.createDataFrame([("w2", "9", "Z"), ("w3", "9", "Z")], s.MEMBERS)
    assert rows(changes.replace_members(members, ids, new)) == [("w2", "9", "Z"), ("w3", "1", "A")]


def test_only_owners_replace_and_members_are_stored_once(spark, lists, members):
    ids = spark.createDataFrame([("w1", 1), ("w3", 1)], "watchlist_id string, user_id bigint")
    new = spark.createDataFrame([("w1", "9", "Z"), ("w1", "9", "Z"), ("w3", "9", "Z")], s.MEMBERS)
    assert rows(changes.replace_members(members, ids, new, lists)) == [("w1", "9", "Z"), ("w3", "1", "A")]


def test_a_key_given_twice_is_stored_once(spark):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    given = spark.createDataFrame([("a", 3), ("a", 2), ("b", 5), ("b", 5)], "k string, v int")
    assert rows(changes.upsert(table, given, ["k"])) == [("a", 2), ("b", 5)]
    assert rows(changes.add_new(table, given, ["k"])) == [("a", 1), ("b", 5)]


def test_pages_are_part_of_the_key(spark, lists):
    many = spark.createDataFrame([("w1", str(k), "T") for k in range(7)], s.MEMBERS)
    nested = changes.nested_watchlists(lists, many, max_rows=3).collect()
    assert sorted((r.watchlist_id, r.page, [m.stock_id for m in r.stocks]) for r in nested) == [
        ("w1", 0, ["0", "1", "2"]), ("w1", 1, ["3", "4", "5"]), ("w1", 2, ["6"]), ("w2", 0, []), ("w3", 0, []),
    ]


def test_coverage_is_saved_and_read(spark, tmp_path):
    path = str(tmp_path / "coverage")
    for name in ("v", "v", "w"):
        record = changes.update_coverage(changes.read_coverage(spark, path), name, as_date("2010-01-01"), as_date("2020-01-01"))
        changes.save_coverage(record, path)
    assert sorted(r.view_name for r in changes.read_coverage(spark, path).collect()) == ["v", "w"]


def test_coverage_is_replaced_by_key(spark):
    old = spark.createDataFrame([("v", dt.date(2000, 1, 1), dt.date(2001, 1, 1)), ("x", None, None)], s.COVERAGE)
    new = changes.update_coverage(old, "v", as_date("2010-01-01"), as_date("2020-01-01"))
    assert sorted(r.view_name for r in new.collect()) == ["v", "x"]
    assert rows(changes.coverage_of(new, "v")) == [(dt.date(2010, 1, 1), dt.date(2020, 1, 1))]
    assert rows(changes.coverage_of(new, "unknown")) == []
    assert changes.update_coverage(new, "y", as_date("2010-01-01"), as_date("2020-01-01")).count() == 3


def test_cascade_delete(spark):
    child = spark.createDataFrame([("t1", 1), ("t2", 2), (None, 3)], "transaction_id string, x int")
    gone = spark.createDataFrame([("t1",)], "transaction_id string")
    assert sorted(r.x for r in changes.cascade_delete(child, gone).collect()) == [2, 3]


def test_missing_keys_match_each_other(spark):
    """A key without a value is one key: replaced, kept and removed like any other."""
    table = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    rows = spark.createDataFrame([(None, 5), ("b", 6)], "k string, v int")
    seen = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert seen(changes.upsert(table, rows, ["k"])) == [("a", 2), ("b", 6), (None, 5)]
    assert seen(changes.add_new(table, rows, ["k"])) == [("a", 2), ("b", 6), (None, 1)]
    assert seen(changes.remove(table, rows, ["k"])) == [("a", 2)]


def step_by_step(lists, members, feed):
    lists, members = {w: (u, n) for w, u, n in lists}, {(w, x): t for w, x, t in members}
    for _, op, w, u, n, x, t in sorted(feed, key=lambda r: r[0]):
        if op == "create":
            if w not in lists and u is not None:
                lists[w] = (u, n)
        elif w in lists and lists[w][0] == u:
            if op == "rename":
                lists[w] = (u, n)
            elif op == "delete":
                del lists[w]
                members = {k: v for k, v in members.items() if k[0] != w}
            elif op == "add":
                members[w, x] = t
            else:
                members.pop((w, x), None)
    return sorted((w, u, n) for w, (u, n) in lists.items()), sorted((w, x, t) for (w, x), t in members.items())


def test_changes_of_all_kinds_in_their_order(spark):
    rng = random.Random(8)
    lists = [(f"w{k}", k % 3, f"n{k}") for k in range(6)]
    members = [(f"w{k % 6}", f"s{k}", f"T{k}") for k in range(18)]
    ops = ["create", "rename", "delete", "add", "add", "add", "drop"]
    feed = [
        (k, rng.choice(ops), f"w{rng.choice((0, 0, 0, 1, 2, 7, 8))}", rng.choice((0, 1, 2, None)), f"m{k}", f"s{rng.randrange(20)}", f"U{k}")
        for k in range(400)
    ]
    rng.shuffle(feed)
    tables = (
        spark.createDataFrame(lists, "watchlist_id string, user_id long, watchlist_name string"),
        spark.createDataFrame(members, "watchlist_id string, stock_id string, ticker_symbol string"),
        spark.createDataFrame(feed, changelog.CHANGES).repartition(5),
    )
    after = [sorted(map(tuple, df.collect())) for df in changelog.apply_changes(*tables)]
    assert tuple(after) == step_by_step(lists, members, feed)
    empty = changelog.apply_changes(*tables[:2], tables[2].limit(0))
    assert [sorted(map(tuple, df.collect())) for df in empty] == [sorted(lists), sorted(members)]
