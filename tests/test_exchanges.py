"""Queries shuffle, count and write no more than their job needs."""

from __future__ import annotations

import re

import pytest

from checks import fixtures as fx
from checks.queries import QUERIES
from conftest import SMALL, same
from quotewright import schemas as s
from quotewright.operators.chunks import pages
from quotewright.plans import batch, refresh
from quotewright.plans.indicators import technical_frame
from quotewright.sources import readers, writers


def exchanges(df) -> list[str]:
    """The plan's exchanges by hash or range."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_wide_frame_shuffles_the_lines_once(spark):
    assert len(exchanges(QUERIES["technical_frame"](spark, SMALL))) == 1


def test_bars_by_stock_are_the_bars(spark):
    rows, parts = fx.placed_bars(spark, SMALL)
    assert parts == rows.rdd.getNumPartitions() and same(rows, fx.bars(spark, SMALL))
    tables = batch.save_indicators(rows, placed=parts)
    usual = batch.save_indicators(fx.bars(spark, SMALL))
    assert same(tables.prices, usual.prices) and same(tables.wide, usual.wide)
    for saved in (tables, usual):
        saved.drop()


def test_bars_of_an_oversized_stock_are_spread(spark):
    rows, parts = fx.placed_bars(spark, SMALL, max_rows=400)
    assert parts is None and same(rows, fx.bars(spark, SMALL))
    assert same(technical_frame(rows, max_rows=400), technical_frame(fx.bars(spark, SMALL)))


@pytest.mark.parametrize("task_rows", [1_000_000, 10])  # one window, or pieces of the longer keys
def test_pages_are_places_in_the_order(spark, task_rows):
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 25), ("b", 3), (None, 8)) for i in reversed(range(n))], "k string, i int")
    paged = pages(rows, ["k"], ["i"], 4, task_rows).collect()
    assert sorted((str(r.k), r.i, r.page) for r in paged) == sorted((str(r.k), r.i, r.i // 4) for r in rows.collect())


def test_pages_of_short_keys_are_shuffled_once(spark):
    """Keys beyond a page but fit for a task were ranged by time, which read all rows several times."""
    rows = spark.range(1000).selectExpr("id % 7 as k", "id as i")
    assert len(exchanges(pages(rows, ["k"], ["i"], 10).groupBy("k", "page").count())) == 1


def test_nested_pages_shuffle_the_lines_once(spark):
    assert len(exchanges(QUERIES["bars_pages"](spark, SMALL))) == 1


def test_refreshed_indicators_are_shuffled_before_the_frames_only(spark, series):
    """The wide rows were joined with the new ids, and marks read the whole look-back for every row."""
    full = series(a=[float(i % 9) for i in range(500)], b=[float(i % 7) for i in range(300)])
    full = writers.persisted(full, "full")
    for new in ("date >= date'2020-09-01'", "date in (date'2020-02-01', date'2020-02-10', date'2020-12-24')"):
        found = refresh.tail_indicators(full, writers.persisted(full.filter(new), "new"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(exchanges(found)) == 1 and "RowFrame, -200, currentrow" not in plan


def test_rows_reached_by_several_new_bars(spark, series):
    full = series(a=[float(i % 9) for i in range(900)], b=[float(i % 7) for i in range(300)])
    new = full.filter("stock_id = 'a' and date in (date'2020-02-01', date'2020-02-10', date'2021-09-01')")
    reached = "stock_id = 'a' and (date between date'2020-02-01' and date'2020-08-28' or date between date'2021-09-01' and date'2022-03-20')"
    assert same(refresh.tail_indicators(full, new), technical_frame(full).filter(reached))


def test_view_of_frames_is_written_where_the_rows_are(spark):
    """A range shuffle would compute the frames twice, once for its sample."""
    written = []

    def save_view(view, path, placed=False):
        written.append((placed, len(exchanges(view))))
        return writers_save_view(view, path, placed)

    writers_save_view, writers.save_view = writers.save_view, save_view
    try:
        QUERIES["technical_from_view"](spark, SMALL)
    finally:
        writers.save_view = writers_save_view
    assert written == [(True, 1)]


def test_chart_documents_are_split_from_one_saved_table(spark):
    texts = ['{"chart":{"result":[{"timestamp":[86400]}]}}', '{"chart', None, '{"chart":{"result":[]}}', "[]"]
    documents = spark.createDataFrame([(str(i), f"T{i}", text) for i, text in enumerate(texts)], "stock_id string, ticker_symbol string, chart_json string")
    whole, rejects = readers.split_chart_documents(documents)
    assert same(rejects, readers.chart_rejects(documents)) and whole.unionByName(rejects).count() == len(texts)
    # a read of the whole ones fails on broken JSON, so it must not meet the others
    assert [(r.stock_id, str(r.date)) for r in readers.explode_chart_json(whole).collect()] == [("0", "1970-01-02")]


def test_chart_rejects_makes_the_documents_once(spark):
    assert not [x for x in exchanges(QUERIES["chart_rejects"](spark, SMALL)) if "year" in x or "l_suppkey" in x or "date" in x]


def test_families_are_columns_of_the_wide_frame(spark):
    bars = fx.bars(spark, SMALL)
    wide = technical_frame(bars)
    for family in s.FAMILIES:
        alone = technical_frame(bars, families=[family])
        assert set(alone.columns) < set(wide.columns)
        assert same(alone, wide.select(*[f"`{c}`" for c in alone.columns]))


def test_reads_of_one_family_compute_no_other(spark):
    plan = QUERIES["read_bollinger"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "spread" in plan and "_delta" not in plan and "gain" not in plan


def test_appended_tables_join_in_place(spark):
    assert exchanges(QUERIES["append_with_indicators"](spark, SMALL)) == []


def test_rows_are_appended_to_tables_by_stock(spark):
    rows, parts = fx.placed_bars(spark, SMALL)
    tables = {name: f"twice_{name}" for name in ("prices", "averages", "bands", "strength")}
    for part in ("date < date'1999-01-01'", "date >= date'1999-01-01'"):
        given = writers.save_bucketed(rows.filter(part), "given", writers.fresh_path(spark, "given"), parts, ["stock_id"], placed=True)
        assert batch.append_by_stock(given, tables, parts) == dict.fromkeys(tables, given.count())
    assert same(readers.read_table(spark, "twice_prices", s.PRICES), rows)
    assert spark.table("twice_strength").count() == rows.count()
    for name in ["given", *tables.values()]:
        writers.drop_view(spark, name)


def test_export_by_stock_keeps_rows_in_place_and_one_file_a_ticker(spark, tmp_path):
    rows, parts = fx.placed_bars(spark, SMALL)
    writers.export_per_ticker(rows, str(tmp_path / "each"), placed=parts is not None)
    folders = list((tmp_path / "each").glob("ticker_symbol=*"))
    assert len(folders) == rows.select("ticker_symbol").distinct().count()
    assert all(len(list(folder.glob("*.csv"))) == 1 for folder in folders)
    back = writers.read_export_per_ticker(spark, str(tmp_path / "each"))
    assert same(back, rows.select(*[f"`{c}`" for c in back.columns]))


def shuffled_bars(df) -> list[str]:
    """The scans of line items or dated rows below an exchange of the plan, once per exchange."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if " Exchange " not in line:
            continue
        below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        found += [x for x in lines[i + 1 : below] if "FileScan" in x and re.search(r"l_shipdate|[\[,]date#", x)]
    return found


@pytest.mark.parametrize("name", ["resolve_requests", "resolve_new_prices", "resolve_open_requests"])
def test_resolved_bars_are_shuffled_once(spark, name, monkeypatch):
    """The bars were shuffled for the companies, the frames of two sources and the view, whose wide rows it moved."""
    saved = {}

    def kept(save):
        def run(df, table, *args, **kwargs):
            saved[table.split("_")[0]] = len(shuffled_bars(df))
            return save(df, table, *args, **kwargs)

        return run

    monkeypatch.setattr(writers, "persisted", kept(writers.persisted))
    monkeypatch.setattr(writers, "save_bucketed", kept(writers.save_bucketed))
    answers = QUERIES[name](spark, SMALL)
    assert (saved["located"], saved.get("joined", 0), saved["computed"]) == (1, 0, 0)
    assert shuffled_bars(answers) == []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    try:
        answers = QUERIES[name](spark, SMALL)
        assert (saved["located"], saved.get("joined", 0), saved["computed"]) == (1, 0, 0)
        assert shuffled_bars(answers) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", ["resolve_requests", "resolve_new_prices", "resolve_open_requests"])
def test_resolved_bars_of_an_oversized_stock(spark, name, monkeypatch):
    """Bars that are not dealt by stock give the same rows."""
    expected = QUERIES[name](spark, SMALL)
    monkeypatch.setattr(fx, "placed_bars", lambda session, sf_dir: (fx.bars(session, sf_dir), None))
    assert same(QUERIES[name](spark, SMALL), expected)
