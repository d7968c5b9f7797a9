from __future__ import annotations

import math
import random
import statistics

import pytest

from conftest import SMALL, same
from quotewright import schemas as s
from quotewright.operators import indicators
from quotewright.plans.indicators import technical_frame

CLOSES = [10.0, 11.0, 10.5, 12.0, 12.0, 11.25, 13.0]


def ema_by_recursion(values, p, seed):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if seed == "newest":
        values = values[::-1]
    a, result = 2 / (p + 1), values[0]
    for v in values[1:]:
        result = a * v + (1 - a) * result
    return result


def close_to(found, expected):
    if expected is None or found is None:
        return found is None and expected is None
    return abs(found - expected) <= 0.005 + 1e-9


def test_worked_example(series, by_day):
    bars = series(a=CLOSES)
    assert by_day(indicators.sma(bars, [3]), "3_days_sma") == [10.0, 10.5, 10.5, 11.17, 11.5, 11.75, 12.08]
    assert by_day(indicators.ema(bars, [3]), "3_days_ema") == [10.0, 10.5, 10.38, 11.13, 11.25, 11.81, 12.06]
    oldest = indicators.ema(bars, [3], seed="oldest")
    assert by_day(oldest, "3_days_ema") == [10.0, 10.5, 10.5, 11.38, 11.63, 11.63, 12.31]
    assert by_day(indicators.rolling_stddev(bars, [3]), "3_days_stddev") == [None, 0.71, 0.5, 0.76, 0.87, 0.43, 0.88]
    assert by_day(indicators.rsi(bars, [3]), "3_days_rsi") == [100.0, 33.33, 66.67, 83.33, 75.0, 66.67, 70.0]


def test_rising_and_flat_series(series, by_day):
    bars = series(rise=[5.0, 6.0, 7.0], flat=[5.0, 5.0, 5.0])
    strength = indicators.rsi(bars, [3])
    assert by_day(strength, "3_days_rsi", stock="rise") == [100.0, 33.33, 40.0]
    assert by_day(strength, "3_days_rsi", stock="flat") == [100.0, 100.0, 100.0]
    textbook = indicators.rsi(bars, [3], zero_loss="hundred")
    assert by_day(textbook, "3_days_rsi", stock="rise") == [100.0, 100.0, 100.0]
    assert by_day(indicators.ema(bars, [3]), "3_days_ema", stock="rise") == [5.0, 5.5, 5.75]
    assert by_day(indicators.ema(bars, [3], seed="oldest"), "3_days_ema", stock="rise") == [5.0, 5.5, 6.25]


def test_falling_series_has_zero_strength(series, by_day):
    assert by_day(indicators.rsi(series(a=[9.0, 8.0, 7.0]), [3]), "3_days_rsi") == [100.0, 0.0, 0.0]


def test_bands_need_two_bars_and_collapse_on_a_flat_series(series, by_day):
    averages = indicators.ema(series(a=[0.1] * 9), [3])
    bands = by_day(indicators.bollinger(averages, [3]), "3_upper_band", "3_lower_band")
    assert bands[0] == (None, None)
    assert set(bands[1:]) == {(0.1, 0.1)}


def test_bands_use_the_rounded_center_and_the_plain_deviation(series, by_day):
    bars = indicators.bollinger(indicators.ema(series(a=CLOSES), [3]), [3])
    third = by_day(bars, "3_upper_band", "3_lower_band")[3]
    deviation = statistics.stdev(CLOSES[1:4])
    assert third == (round(11.13 + 2 * deviation, 2), round(11.13 - 2 * deviation, 2))


def test_rounded_deviation_around_the_simple_average(series, by_day):
    averages = indicators.sma(series(a=CLOSES), [3])
    bands = indicators.bollinger(averages, [3], center="sma", round_std=True)
    assert by_day(bands, "3_upper_band", "3_lower_band")[3] == (11.17 + 2 * 0.76, round(11.17 - 2 * 0.76, 2))


def test_random_series_with_gaps_match_plain_recomputation(series, by_day):
    rng = random.Random(7)
    periods = [1, 2, 3, 7, 10, 33]
    closes = {
        "a": [None if rng.random() < 0.2 else round(rng.uniform(1, 500), 2) for _ in range(80)],
        "b": [round(rng.uniform(1, 500), 3) for _ in range(45)],
        "c": [None, None, 3.0],
    }
    bars = series(**closes)
    newest, oldest = indicators.ema(bars, periods), indicators.ema(bars, periods, seed="oldest")
    average, spread = indicators.sma(bars, periods), indicators.rolling_stddev(bars, periods)
    strength = indicators.rsi(bars, periods)
    for stock, values in closes.items():
        changes = [0.0] + [
            0.0 if x is None or y is None else y - x for x, y in zip(values, values[1:], strict=False)
        ]
        columns = {
            df: [name(p) for p in periods]
            for df, name in (
                (newest, s.ema_name),
                (oldest, s.ema_name),
                (average, s.sma_name),
                (spread, lambda p: f"{p}_days_stddev"),
                (strength, s.rsi_name),
            )
        }
        read = {
            (df, c): [row[i] for row in rows]
            for df, names in columns.items()
            for rows in [by_day(df, "date", *names, stock=stock)]
            for i, c in enumerate(names, 1)
        }
        for p in periods:
            frames = [values[max(0, i - p + 1) : i + 1] for i in range(len(values))]
            present = [[v for v in f if v is not None] for f in frames]
            expected = {
                (newest, s.ema_name(p)): [ema_by_recursion(f, p, "newest") for f in frames],
                (oldest, s.ema_name(p)): [ema_by_recursion(f, p, "oldest") for f in frames],
                (average, s.sma_name(p)): [statistics.fmean(f) if f else None for f in present],
                (spread, f"{p}_days_stddev"): [statistics.stdev(f) if len(f) > 1 else None for f in present],
                (strength, s.rsi_name(p)): [
                    expected_rsi(changes[max(0, i - p + 1) : i + 1]) for i in range(len(values))
                ],
            }
            for (df, column), wanted in expected.items():
                assert all(map(close_to, read[df, column], wanted)), (stock, column)


def expected_rsi(changes):
    up = statistics.fmean(max(c, 0) for c in changes)
    down = statistics.fmean(max(-c, 0) for c in changes)
    if down == 0:
        return 100.0 if up == 0 else 100 - 100 / (1 + up)
    return 100 - 100 / (1 + up / down)


def test_several_bars_on_one_day_are_ordered_by_id(spark, series, by_day):
    bars = series(a=[1.0, 2.0, 3.0, 4.0]).selectExpr(
        *[c if c != "date" else "date'2020-01-01' as date" for c in s.PRICES.fieldNames()]
    )
    assert by_day(indicators.price_change(bars), "price_change") == [None, 1.0, 1.0, 1.0]


def test_price_change_and_its_parts(series, by_day):
    moves = indicators.gain_loss(indicators.price_change(series(a=[3.0, 5.0, 4.0]), first=0))
    assert by_day(moves, "price_change", "gain", "loss") == [(0.0, 0.0, 0.0), (2.0, 2.0, 0.0), (-1.0, 0.0, 1.0)]


def test_wrong_options_are_rejected(series):
    bars = series(a=CLOSES)
    with pytest.raises(ValueError, match="averages first"):
        indicators.bollinger(bars, [5])
    with pytest.raises(ValueError, match="seed"):
        indicators.ema(bars, seed="first")
    with pytest.raises(ValueError, match="center"):
        indicators.bollinger(bars, center="median")
    with pytest.raises(ValueError, match="zero_loss"):
        indicators.rsi(bars, zero_loss="none")


def test_zones(spark):
    df = spark.createDataFrame([(70.01,), (70.0,), (30.0,), (29.99,)], "`20_days_rsi` double")
    zones = [r.zone for r in indicators.rsi_zone(df, "20_days_rsi").collect()]
    assert zones == ["overbought", "neutral", "neutral", "oversold"]


def test_empty_input(series):
    assert technical_frame(series(a=[])).count() == 0


def test_wide_frame_agrees_with_the_single_operators(spark):
    from checks import fixtures as fx

    bars = fx.bars(spark, SMALL)
    wide = technical_frame(bars).drop("cal_id")
    single = indicators.ema(indicators.sma(bars, prefix="ma_"), prefix="ma_")
    single = indicators.rsi(indicators.bollinger(single, center_prefix="ma_", prefix="bb_"))
    single = single.select(*[f"`{c}`" for c in wide.columns])
    assert same(wide, single)


def test_range_is_applied_after_the_frames(spark):
    from checks import fixtures as fx

    bars = fx.bars(spark, SMALL)
    start, end = "1998-03-01", "1998-06-30"
    inside = technical_frame(bars).filter(f"date between date'{start}' and date'{end}'")
    assert inside.count() > 0 and same(technical_frame(bars, start, end), inside)
    assert technical_frame(bars, start, None).count() == bars.count()


def test_values_stay_in_their_bounds(spark):
    from checks import fixtures as fx

    wide = technical_frame(fx.bars(spark, SMALL)).cache()
    for p in s.BAND_PERIODS:
        crossed = f"`bb_{p}_lower_band` > `ma_{p}_days_ema` or `bb_{p}_upper_band` < `ma_{p}_days_ema`"
        assert wide.filter(crossed).count() == 0
    for p in s.RSI_PERIODS:
        assert wide.filter(f"not `{p}_days_rsi` between 0 and 100").count() == 0
    wide.unpersist()


def test_one_ticker_alone_gets_the_same_values(spark):
    from checks import fixtures as fx

    bars = fx.bars(spark, SMALL)
    alone = technical_frame(bars.filter("stock_id = '3'"))
    among = technical_frame(bars).filter("stock_id = '3'")
    assert alone.count() > 400 and same(alone, among)


def test_rounding_breaks_ties_away_from_zero(spark):
    from quotewright.functions.numeric import round2

    values = [1.005, 2.675, -1.005, 0.125, -0.001, 1234567.125, 0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.y for r in df.select(round2("x").alias("y")).collect()]
    assert found == [1.01, 2.68, -1.01, 0.13, 0.0, 1234567.13, 0.0, None]
    assert math.copysign(1, found[4]) == 1


def test_rounding_has_no_ceiling(spark):
    from quotewright.functions.numeric import round2

    same_value = [9e7, 1e15, 123456789012345.6, 9.3e16, 1e18, 1e300, math.inf, -math.inf, -4.5e13]
    values = [89999999.995, 90000000.125, -90000000.125, 1234567890123.375, 44999999999999.625, *same_value, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.y for r in df.select(round2("x").alias("y")).collect()]
    assert found[:5] == [90000000.0, 90000000.13, -90000000.13, 1234567890123.38, 44999999999999.63]
    assert found[5:-1] == same_value and math.isnan(found[-1])


def test_large_values_round_as_decimals_do(spark):
    """Thousandths of large values and values where doubles are coarser than cents."""
    import duckdb

    from quotewright.functions.numeric import round2_decimal

    rng = random.Random(11)
    wide = [round(10 ** rng.uniform(7.9, 13.7), 3) for _ in range(4000)] + [rng.uniform(2e13, 5e13) for _ in range(2000)]
    values = [(sign * x,) for x in wide for sign in (1.0, -1.0)]
    rounded = spark.createDataFrame(values, "x double").select("x", round2_decimal("x").alias("y")).collect()
    connection = duckdb.connect()
    connection.execute("create table t (x double, y double)")
    connection.executemany("insert into t values (?, ?)", [tuple(r) for r in rounded[::4]])
    twin = "case when abs(x) >= 4.5e13 then x else cast(round(cast(if(abs(x) >= 4.5e13, 0, x) as decimal(28,8)), 2) as double) end"
    assert connection.sql(f"select x, y, {twin} from t where y is distinct from {twin} limit 3").fetchall() == []
