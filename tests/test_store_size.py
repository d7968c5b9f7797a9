"""The store writes wide rows once per table and does not shuffle them to replace some."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SMALL, same
from quotewright import schemas as s
from quotewright.operators import technical
from quotewright.plans import refresh, resolve
from quotewright.plans.indicators import technical_frame
from quotewright.sources import writers
from test_exchanges import exchanges


def test_a_store_is_written_without_a_wide_copy_and_late_bars_shuffle_no_wide_rows(spark, series, tmp_path, monkeypatch):
    full = series(a=[float(i % 9) for i in range(760)], b=[float(i % 7) for i in range(420)])
    copies, anew, persisted, overwrite = [], [], writers.persisted, writers.overwrite_years

    def kept(df, name, *args):
        copies.append((name, len(df.columns)))
        return persisted(df, name, *args)

    def written(rows, path):
        anew.append((path.rsplit("/", 1)[-1], exchanges(rows)))
        overwrite(rows, path)

    monkeypatch.setattr(writers, "persisted", kept)
    monkeypatch.setattr(writers, "overwrite_years", written)
    gaps = "stock_id = 'b' or date not in (date'2020-03-01', date'2020-08-05')"
    store = refresh.create_store(full.filter(gaps).filter("date < date'2021-12-20'"), str(tmp_path / "store"))
    assert [x for x in copies if x[1] > 20] == []  # a copy of all indicators was saved first
    refresh.run_refresh(spark, store, full, saved=True)
    assert [x for x in copies if x[1] > 20 and x[0] != "tail"] == []
    assert anew == [(name, []) for name in ("averages", "bands", "strength", "view")]
    assert same(store.read(spark, "view").select(*[f"`{c}`" for c in s.VIEW_COLUMNS]), technical_frame(full).select(*[f"`{c}`" for c in s.VIEW_COLUMNS]))
    for name in ("prices", "averages", "bands", "strength", "view"):
        files = list((tmp_path / "store" / name).glob("year=2*/*.parquet"))
        assert files and all(".zstd." in file.name for file in files), name
        assert store.read(spark, name).count() == full.count()


def test_prices_dealt_by_stock_are_framed_where_they_are(spark, tmp_path, monkeypatch):
    from checks import fixtures as fx

    rows, parts = fx.placed_ticks(spark, SMALL)
    assert same(rows, fx.tick_prices(spark, SMALL)) and parts == rows.rdd.getNumPartitions()
    dealt = writers.persisted(rows, "dealt", parts)
    appended, append = [], writers.append_by_year

    def counted(df, path):
        appended.append(len(exchanges(df)))
        return append(df, path)

    monkeypatch.setattr(writers, "append_by_year", counted)
    store = refresh.create_store(dealt, str(tmp_path / "placed"), placed=True)
    assert appended == [0] * 5
    monkeypatch.undo()
    assert same(store.read(spark, "view").select(*[f"`{c}`" for c in s.VIEW_COLUMNS]), technical_frame(rows).select(*[f"`{c}`" for c in s.VIEW_COLUMNS]))


def test_days_that_the_horizon_reaches_are_written_once(spark, series, tmp_path, monkeypatch):
    monkeypatch.setattr(technical, "view_range", lambda as_of: (F.date_sub(F.lit(as_of).cast("date"), 100), F.lit(as_of).cast("date")))
    full = series(a=[float(i % 9) for i in range(420)])
    store = refresh.create_store(full, str(tmp_path / "store"), "2020-12-01")
    days = lambda: [str(x) for x in store.read(spark, "view").agg(F.min("date"), F.max("date"), F.count("*")).first()]
    assert days() == ["2020-08-23", "2020-12-01", "101"]
    copies, persisted = [], writers.persisted

    def kept(df, name, *args):
        copies.append(len(df.columns))
        return persisted(df, name, *args)

    monkeypatch.setattr(writers, "persisted", kept)
    refresh.run_refresh(spark, store, full, "2021-01-20", saved=True)
    assert days() == ["2020-10-12", "2021-01-20", "101"]
    assert max(copies) <= 20  # the rows were saved beside the view and their ids shuffled


def test_joined_tables_are_asked_for_undecided_stocks_only(spark, series):
    bars = series(a=[1.0, 2.0, 3.0], b=[1.0, 2.0], c=[4.0])
    wide = technical_frame(bars)
    day = dt.date(2020, 1, 1)
    fields = ["ticker_symbol", "country", "start_date", "end_date", "technical", "stock_id"]
    known = spark.createDataFrame([(k.upper(), "USA", day, day, k != "c", k) for k in "abcd"], f"{fields[0]} string, country string, start_date date, end_date date, technical boolean, stock_id string")
    view, asked = wide.filter("stock_id = 'a'"), []

    def joined(stocks):
        asked.append(sorted(r.stock_id for r in stocks.collect()))
        return wide.join(stocks, "stock_id", "left_semi")

    chosen = resolve.choose_sources(known, bars, joined, view)
    assert asked == [["b"]]
    assert {r.stock_id: r.source for r in chosen.collect()} == {"a": "view", "b": "joined", "c": "stored", "d": "computed"}
    assert same(chosen, resolve.choose_sources(known, bars, wide, view))
