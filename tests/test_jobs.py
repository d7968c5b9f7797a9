from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, same
from quotewright import schemas as s
from quotewright.functions.dates import as_date
from quotewright.operators import changes, technical
from quotewright.operators.indicators import lookback
from quotewright.plans import refresh
from quotewright.plans.batch import append_indicators
from quotewright.plans.bootstrap import open_market
from quotewright.plans.indicators import technical_frame
from quotewright.sources import readers, writers
from quotewright.streaming import ingest


def values(n, seed=3):
    rng = random.Random(seed)
    return [round(rng.uniform(10, 20), 2) for _ in range(n)]


def company(spark, *names):
    return spark.createDataFrame([(n, n.upper(), n, "X", "Y", "USA") for n in names], s.COMPANIES)


def request(spark, *rows):
    full = [(t, c, dt.date.fromisoformat(a), dt.date.fromisoformat(b), k) for t, c, a, b, k in rows]
    return spark.createDataFrame(full, s.REQUESTS)


def test_market_from_nothing_to_answers(spark, series):
    """Load companies and a sample, run the batch, ask; what is missing comes from landed bars."""
    landed = series(a=values(30), b=values(30, 4), c=values(30, 5))
    prices = landed.filter("stock_id = 'a' or (stock_id = 'b' and date <= date'2020-01-10')")
    coverage = spark.createDataFrame([], s.COVERAGE)
    market = open_market(company(spark, "a", "b", "c", "d"), prices, landed, coverage, "2020-01-20")
    covered = market.coverage.first()
    assert (covered.start_date, covered.end_date) == (dt.date(2010, 1, 22), dt.date(2020, 1, 20))
    resolution = market.answer(
        request(
            spark,
            ("A", "USA", "2020-01-05", "2020-01-08", True),
            ("A", "USA", "2020-01-22", "2020-01-24", True),
            ("A", "USA", "2020-01-05", "2020-01-06", False),
            ("A", "USA", "2020-01-05", "2020-01-06", False),
            ("B", "USA", "2020-01-09", "2020-01-12", True),
            ("B", "USA", "2020-01-11", "2020-01-12", False),
            ("C", "USA", "2020-01-03", "2020-01-04", True),
            ("D", "USA", "2020-01-03", "2020-01-04", True),
            ("A", "France", "2020-01-05", "2020-01-08", True),
            ("Z", "USA", "2020-01-05", "2020-01-08", True),
        )
    )
    counts = {}
    for r in resolution.answers.collect():
        counts[r.ticker_symbol, r.source] = counts.get((r.ticker_symbol, r.source), 0) + 1
        assert (r["ma_5_days_sma"] is not None) == (r.source in ("view", "joined", "computed"))
    assert counts == {
        ("A", "view"): 4,
        ("A", "joined"): 3,
        ("A", "stored"): 2,
        ("B", "view"): 2,
        ("B", "landed"): 2,
        ("C", "computed"): 2,
    }
    wide = technical_frame(landed.filter("stock_id = 'c'")).filter("date = date'2020-01-04'").first()
    answer = resolution.answers.filter("ticker_symbol = 'C' and date = date'2020-01-04'").first()
    assert answer["ma_20_days_ema"] == wide["ma_20_days_ema"]
    added = resolution.new_prices.groupBy("stock_id").count().collect()
    assert {r.stock_id: r["count"] for r in added} == {"b": 20, "c": 30}
    assert {r.stock_id for r in resolution.new_technical.select("stock_id").distinct().collect()} == {"c"}


def test_prices_answer_when_there_are_no_indicators(spark, series):
    from quotewright.plans.resolve import resolve

    prices = series(a=values(5))
    nothing = technical_frame(prices).select(*s.VIEW_COLUMNS).filter("false")
    asked = request(spark, ("A", "USA", "2020-01-01", "2020-01-03", True))
    found = resolve(asked, company(spark, "a"), prices, nothing, nothing, prices)
    assert [r.source for r in found.answers.collect()] == ["stored"] * 3
    assert found.new_prices.count() == 0 and found.new_technical.count() == 0


def test_refresh_adds_newer_bars_once(series):
    full = series(a=values(30), b=values(20, 4), new=values(3))
    stored = full.filter("date <= date'2020-01-10' and stock_id <> 'new'")
    landed = full.filter("date >= date'2020-01-08'").unionByName(full.filter("stock_id = 'new'"))
    once = refresh.refresh(stored, landed.unionByName(landed))
    assert same(once, full)
    assert same(refresh.refresh(once, landed), once)


def test_refresh_fills_gaps_and_keeps_null_keys_once(spark, series):
    full = series(a=values(30))
    odd = spark.createDataFrame([("x", None, None, None, 1.0, 1.0, 1.0, 1, 1.0)], s.PRICES)
    stored = full.filter("date <> date'2020-01-05'")
    once = refresh.refresh(stored, full.unionByName(odd))
    assert same(once, full.unionByName(odd))
    assert same(refresh.refresh(once, full.unionByName(odd)), once)


def test_a_late_bar_corrects_the_bars_behind_it(series):
    full = series(a=values(500), b=values(300, 4))
    late = full.filter("stock_id = 'a' and date = date'2020-03-01'")
    found = refresh.tail_indicators(full, late)
    expected = technical_frame(full).filter("stock_id = 'a' and date between date'2020-03-01' and date'2020-09-17'")
    assert expected.count() == 201
    assert same(found, expected)


def test_refresh_job_writes_once_and_heals(spark, series, tmp_path):
    full = series(a=values(420), b=values(300, 4), new=values(3))
    stored = full.filter("stock_id <> 'new' and date <> date'2020-02-02' and date < date'2021-01-20'")
    store = refresh.create_store(stored, str(tmp_path / "store"))
    first = refresh.run_refresh(spark, store, full)
    assert first["prices"] == full.count() - stored.count()
    layouts = {"averages": s.MOVING_AVERAGES, "bands": s.BANDS, "strength": s.RSI}
    wide = technical_frame(full)
    for name, layout in layouts.items():
        assert store.read(spark, name).count() == full.count(), name
    view = store.read(spark, "view").select(*[f"`{c}`" for c in s.VIEW_COLUMNS])
    assert same(view, wide.select(*[f"`{c}`" for c in s.VIEW_COLUMNS]))
    assert set(refresh.run_refresh(spark, store, full).values()) == {0}
    # a run that stopped after the prices were appended is completed by the next
    extra = series(c=values(5))
    writers.append_by_year(extra, store.prices)
    assert refresh.run_refresh(spark, store, full)["strength"] == 5
    assert store.read(spark, "view").filter("stock_id = 'c'").count() == 5


def test_refresh_job_computes_bars_without_a_key(spark, series, tmp_path):
    """Whatever of stock, ticker and date is missing, the tables hold what a new store would."""
    without = lambda c: lambda rows: rows.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
    bars = series(a=values(700))
    for name, column in (("x", "ticker_symbol"), ("y", "stock_id")):
        bars = bars.unionByName(without(column)(series(**{name: values(700)})))
    full = bars.unionByName(without("date")(series(a=values(1)).withColumn("transaction_id", F.lit("a:late"))))
    stored = bars.filter("date <= date'2021-11-20'")
    store = refresh.create_store(stored, str(tmp_path / "store"))
    for landed in (bars, full):
        added = landed.count() - stored.count()
        counts = refresh.run_refresh(spark, store, landed)
        assert counts["prices"] == added and counts["strength"] >= added
        whole = refresh.create_store(landed, str(tmp_path / f"whole{added}"))
        for name in ("prices", "averages", "bands", "strength", "view"):
            assert same(store.read(spark, name), whole.read(spark, name)), name
        assert set(refresh.run_refresh(spark, store, landed).values()) == {0}
        stored = landed


STORED = ("prices", "averages", "bands", "strength", "view")


def same_store(spark, left, right, names=STORED):
    return [name for name in names if not same(left.read(spark, name), right.read(spark, name))]


def test_a_refresh_reads_tails_instead_of_older_prices(spark, series, tmp_path):
    """Bars of 2022 are refreshed although the folders of all earlier years are unreadable."""
    full = series(a=values(900), b=values(890, 4), young=values(780, 5), new=values(0))
    full = full.unionByName(series(new=values(900)).filter("date >= date'2022-02-01'"))
    store = refresh.create_store(full.filter("date < date'2022-01-10'"), str(tmp_path / "store"))
    whole = refresh.create_store(full, str(tmp_path / "whole"))
    hidden = []
    for name in STORED:
        for year in (2020, 2021):
            for file in (tmp_path / "store" / name / f"year={year}").glob("*.parquet"):
                hidden.append((file, file.read_bytes()))
                file.write_bytes(b"unreadable")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    new = full.filter("date >= date'2022-01-10'")
    assert refresh.run_refresh(spark, store, new)["strength"] == new.count()
    for file, content in hidden:
        file.write_bytes(content)
    assert same_store(spark, store, whole) == []


@pytest.mark.parametrize("writes", [1, 3])
def test_a_stopped_refresh_is_completed(spark, series, tmp_path, monkeypatch, writes):
    """Whichever table it stopped before, the next run completes it, and adds what is new since."""
    full = series(a=values(320), b=values(300, 4))
    store = refresh.create_store(full.filter("date < date'2020-10-20'"), str(tmp_path / "store"))
    append, left = writers.append_by_year, [writes]

    def stopping(rows, path):
        if not left[0]:
            raise OSError("stopped")
        left[0] -= 1
        return append(rows, path)

    monkeypatch.setattr(writers, "append_by_year", stopping)
    with pytest.raises(OSError, match="stopped"):
        refresh.run_refresh(spark, store, full.filter("date < date'2020-10-25'"))
    monkeypatch.undo()
    counts = refresh.run_refresh(spark, store, full)
    assert counts["strength"] == full.filter("date >= date'2020-10-20'").count()
    assert same_store(spark, store, refresh.create_store(full, str(tmp_path / "whole"))) == []
    assert set(refresh.run_refresh(spark, store, full).values()) == {0}


def test_the_view_slides_with_its_horizon(spark, series, tmp_path, monkeypatch):
    """Forward inside a year and across years, with and without new bars, and back."""
    monkeypatch.setattr(technical, "view_range", lambda as_of: (F.date_sub(as_date(as_of), 300), as_date(as_of)))
    full = series(a=values(800), b=values(700, 4))
    store = refresh.create_store(full.filter("date < date'2021-02-01'"), str(tmp_path / "store"), "2020-11-15")
    steps = [("2020-12-20", "2021-02-01"), ("2021-03-10", "2021-04-01"), ("2021-12-01", "2022-03-20"), ("2021-06-01", "2022-03-20")]
    for k, (as_of, until) in enumerate(steps):
        landed = full.filter(f"date < date'{until}'")
        refresh.run_refresh(spark, store, landed, as_of)
        whole = refresh.create_store(landed, str(tmp_path / f"whole{k}"), as_of)
        assert same_store(spark, store, whole) == []
        covered = changes.coverage_of(changes.read_coverage(spark, store.coverage), refresh.STORED_VIEW).collect()
        assert [str(r.end_date) for r in covered] == [as_of]
        years = {int(x.name[5:]) for x in (tmp_path / "store" / "view").glob("year=2*")}
        assert years == {r.y for r in whole.read(spark, "view").select(F.year("date").alias("y")).distinct().collect()}
    # a late bar inside the horizon, and the horizon as it was
    late = full.filter("stock_id = 'b' and date = date'2021-01-07'").withColumn("transaction_id", F.lit("late")).withColumn("close", F.lit(3.0))
    landed = full.filter("date < date'2022-03-20'").unionByName(late)
    refresh.run_refresh(spark, store, landed)
    assert same_store(spark, store, refresh.create_store(landed, str(tmp_path / "late"), "2021-06-01")) == []


def test_a_store_keeps_several_closes_a_day(spark, series, tmp_path):
    bars = series(a=values(300), b=values(250, 4))
    second = bars.withColumn("transaction_id", F.concat("transaction_id", F.lit("+"))).withColumn("close", F.col("close") + 1)
    full = bars.unionByName(second)
    copies = bars.withColumn("transaction_id", F.concat("transaction_id", F.lit("copy")))
    store = refresh.create_store(full.filter("date < date'2020-08-01'").unionByName(copies.limit(50)), str(tmp_path / "store"))
    assert refresh.run_refresh(spark, store, full.unionByName(copies))["prices"] == full.filter("date >= date'2020-08-01'").count()
    wide = technical_frame(full)
    assert same(store.read(spark, "view").select(*[f"`{c}`" for c in s.VIEW_COLUMNS]), wide.select(*[f"`{c}`" for c in s.VIEW_COLUMNS]))
    # one more close on a day that is stored is a late bar
    more = bars.filter("date = date'2020-05-05'").withColumn("transaction_id", F.lit("x")).withColumn("close", F.lit(9.5)).limit(1)
    assert refresh.run_refresh(spark, store, full.unionByName(more))["prices"] == 1
    assert same_store(spark, store, refresh.create_store(full.unionByName(more), str(tmp_path / "whole"))) == []


def test_upsert_replaces_rows_without_a_date(spark, series, tmp_path):
    path = str(tmp_path / "p")
    undated = series(a=[1.0, 2.0]).withColumn("date", F.lit(None).cast("date"))
    writers.create_by_year(spark, s.PRICES, path)
    for rows in (undated, undated.withColumn("close", F.lit(5.0)), series(b=[3.0]).unionByName(undated)):
        assert writers.upsert_by_year(rows, path, "transaction_id") == rows.count()
        held = writers.read_by_year(spark, path, s.PRICES).drop("year")
        assert same(held, rows)


def test_pruned_history_gives_the_same_indicators(spark):
    from checks import fixtures as fx

    bars = fx.bars(spark, SMALL)
    new = bars.filter("date >= date'2001-06-01'")
    expected = technical_frame(bars).filter("date >= date'2001-06-01'")
    assert same(refresh.tail_indicators(bars, new), expected)
    assert lookback() == 200
    starts = new.groupBy(*s.TICKER).agg(F.min("date").alias("start"))
    kept = refresh.recent_history(bars, starts)
    assert kept.count() == new.count() + 200 * starts.count()


def test_history_of_tables_split_by_year_reads_few_years(spark, series, tmp_path):
    bars = series(a=values(1500), b=values(1300, 4), young=values(1250, 5))
    bars = bars.filter("stock_id <> 'young' or date > date'2023-05-01' or date < date'2020-06-01'")
    writers.create_by_year(spark, s.PRICES, str(tmp_path / "p"))
    writers.append_by_year(bars, str(tmp_path / "p"))
    table = writers.read_by_year(spark, str(tmp_path / "p"), s.PRICES)
    starts = bars.groupBy(*s.TICKER).agg(F.max("date").alias("start"))
    kept = refresh.recent_history(table, starts, 120)
    assert same(kept, refresh.recent_history(bars, starts, 120).select(*kept.columns))
    assert {r.stock_id: r["count"] for r in kept.groupBy("stock_id").count().collect()} == {"a": 121, "b": 121, "young": 121}


def test_no_step_of_the_refresh_gathers_a_ticker(series, monkeypatch):
    bars = series(a=values(300), b=values(10))
    new = refresh.missing_bars(bars, bars)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("Window")
    starts = bars.groupBy(*s.TICKER).agg(F.max("date").alias("start"))
    broadcast = refresh.recent_history(bars, starts, 20)
    monkeypatch.setattr(refresh, "MAX_BROADCAST_ROWS", 0)
    assert same(refresh.recent_history(bars, starts, 20), broadcast) and broadcast.count() == 21 + 10


def test_combined_append(spark, series, tmp_path):
    bars = series(a=values(4), b=values(3))
    paths = {name: str(tmp_path / name) for name in ("prices", "averages", "bands", "strength")}
    assert append_indicators(technical_frame(bars), bars, paths) == dict.fromkeys(paths, 7)
    assert readers.read_table(spark, paths["strength"], s.RSI).count() == 7


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "sink", "checkpoint")}


def test_stream_takes_each_bar_once(spark, series, folders):
    full = series(a=values(400), b=values(10))

    def land(rows):
        s.conform(rows, s.PRICES).coalesce(1).write.mode("append").parquet(folders["landing"])

    def run():
        ingest.ingest_landed(spark, folders["landing"], folders["sink"], folders["checkpoint"], files_per_batch=1)
        return ingest.read_sink(spark, folders["sink"]).select(*s.PRICES.fieldNames())

    ingest.create_sink(spark, folders["sink"], full.filter("date <= date'2020-01-05'"))
    land(full.filter("date between date'2020-01-03' and date'2020-03-01'"))
    land(full.filter("date between date'2020-01-03' and date'2020-03-01'"))
    first = run()
    assert same(first, full.filter("date <= date'2020-03-01'"))
    land(full.filter("date > date'2020-06-01'"))
    land(full.filter("date between date'2020-02-01' and date'2020-06-01'"))
    assert same(run(), full)
    assert same(run(), full)


def test_replayed_batch_adds_nothing(spark, series, folders):
    ingest.create_sink(spark, folders["sink"])
    bars = series(a=values(5))
    for _ in range(2):
        ingest.append_new(bars.unionByName(bars), folders["sink"])
    assert ingest.read_sink(spark, folders["sink"]).count() == 5
    ingest.append_new(bars.filter("false"), folders["sink"])


def test_bars_without_a_key_are_rejected_visibly(spark, series, folders):
    ingest.create_sink(spark, folders["sink"])
    good = series(a=values(3))
    bad = good.limit(1).withColumn("date", F.lit(None).cast("date"))
    for batch in (good.unionByName(bad), bad):
        with pytest.raises(ValueError, match="1 bars lack"):
            ingest.append_new(batch, folders["sink"])
    for _ in range(2):  # a replay
        ingest.append_new(good.unionByName(bad), folders["sink"], rejects=folders["landing"])
        ingest.append_new(bad, folders["sink"], rejects=folders["landing"] + "2")
    assert ingest.read_sink(spark, folders["sink"]).count() == 3
    assert spark.read.parquet(folders["landing"]).count() == 1 == spark.read.parquet(folders["landing"] + "2").count()


def test_open_ranges_and_tickers_of_several_companies(spark, series):
    from quotewright.plans.resolve import bulk_load, request_prices

    bars = series(a=values(5), b=values(3))
    both = company(spark, "a", "b").withColumn("ticker_symbol", F.lit("A"))
    asked = spark.createDataFrame(
        [("A", "USA", None, None, False), ("A", "USA", dt.date(2020, 1, 3), None, False), ("A", "USA", None, dt.date(2020, 1, 1), False)],
        s.REQUESTS,
    )
    found = request_prices(asked, both, bars).groupBy("stock_id").count().collect()
    assert {r.stock_id: r["count"] for r in found} == {"a": 5 + 3 + 1, "b": 3 + 1 + 1}
    assert bulk_load(both, bars, bars.filter("stock_id = 'a'")).count() == 3


def test_saved_copy_is_read_back(spark, series):
    bars = series(a=values(3))
    copy = writers.persisted(bars, "copy")
    assert same(copy, bars) and copy.schema == bars.schema
    assert "Scan" in copy._jdf.queryExecution().executedPlan().toString()
