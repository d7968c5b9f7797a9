"""Technical indicators for all tickers at once.

Each operator keeps the input columns and adds its own.  Filter by date after,
never before: a frame needs the bars that precede it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from quotewright import schemas as s
from quotewright.functions import rolling as r
from quotewright.functions.numeric import round2_sql
from quotewright.operators.chunks import MAX_ROWS, per_ticker


def _add(df: DataFrame, results: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in results.items()})


def _rounded(df: DataFrame, raw: Mapping[str, str]) -> DataFrame:
    """Add the raw values, then round them in a step of its own."""
    return _add(_add(df, raw), {name: round2_sql(f"`{name}`") for name in raw})


def _in_order(df: DataFrame, names: Sequence[str], before: Sequence[str]) -> DataFrame:
    return df.select(*[f"`{c}`" for c in [*before, *names]])


def _with_frames(
    df: DataFrame,
    wanted: Mapping[int, Mapping[str, r.Measure]],
    name: Callable[[int], str],
    value: Callable[[int], str],
    max_rows: int,
) -> DataFrame:
    """Add the rounded column ``name(p)`` = ``value(p)`` for every wanted period."""

    def compute(rows, keys):
        framed = r.with_frames(
            rows, r.window_sql(keys), wanted, lambda part, p: _rounded(part, {name(p): value(p)})
        )
        return _in_order(framed, [name(p) for p in wanted], rows.columns)

    return per_ticker(df, compute, max(wanted), max_rows=max_rows)


def sma(df: DataFrame, periods: Sequence[int] = s.MA_PERIODS, prefix: str = "", max_rows: int = MAX_ROWS) -> DataFrame:
    """Simple moving average of ``close`` over the last ``p`` bars."""
    wanted = {p: r.count_and_sum("close") for p in periods}
    return _with_frames(df, wanted, lambda p: prefix + s.sma_name(p), r.mean_sql, max_rows)


def ema(
    df: DataFrame,
    periods: Sequence[int] = s.MA_PERIODS,
    prefix: str = "",
    seed: str = "newest",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Exponential moving average of ``close`` within the frame of the last ``p`` bars.

    ``seed="newest"`` starts from the newest bar and walks back in time;
    ``seed="oldest"`` is the conventional direction.
    """
    if seed not in ("newest", "oldest"):
        raise ValueError(f"seed must be 'newest' or 'oldest', not {seed!r}")
    wanted = {p: r.weighted("close", p, seed) for p in periods}
    return _with_frames(df, wanted, lambda p: prefix + s.ema_name(p), lambda p: r.ema_sql(p, seed), max_rows)


def rolling_stddev(df: DataFrame, periods: Sequence[int] = s.BAND_PERIODS, max_rows: int = MAX_ROWS) -> DataFrame:
    """Sample standard deviation of ``close`` over the last ``p`` bars."""
    wanted = {p: r.spread("close") for p in periods}
    return _with_frames(df, wanted, lambda p: f"{p}_days_stddev", r.stddev_sql, max_rows)


def _bands(center: str, deviation: str, upper: str, lower: str) -> dict[str, str]:
    return {
        upper: f"{center} + {s.BAND_WIDTH} * {deviation}",
        lower: f"{center} - {s.BAND_WIDTH} * {deviation}",
    }


def bollinger(
    df: DataFrame,
    periods: Sequence[int] = s.BAND_PERIODS,
    center_prefix: str = "",
    prefix: str = "",
    center: str = "ema",
    round_std: bool = False,
    max_rows: int = MAX_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Bands ``center +/- 2 * stddev``; ``center`` names existing average columns.

    ``round_std`` rounds the deviation before it is doubled.  A frame of one row
    has no deviation, hence NULL bands.  ``sized_by`` may name the bars that ``df`` was
    computed from: they are counted instead of computing the averages for a count.
    """
    name = {"ema": s.ema_name, "sma": s.sma_name}.get(center)
    if name is None:
        raise ValueError(f"center must be 'ema' or 'sma', not {center!r}")
    centers = {p: center_prefix + name(p) for p in periods}
    missing = [c for c in centers.values() if c not in df.columns]
    if missing:
        raise ValueError(f"compute the averages first; missing columns: {missing}")
    bands = {p: (prefix + s.upper_name(p), prefix + s.lower_name(p)) for p in periods}

    def finish(part: DataFrame, p: int) -> DataFrame:
        deviation = {"_stddev": r.stddev_sql(p)}
        measured = _rounded(part, deviation) if round_std else _add(part, deviation)
        return _rounded(measured, _bands(f"`{centers[p]}`", "_stddev", *bands[p])).drop("_stddev")

    def compute(rows, keys):
        framed = r.with_frames(rows, r.window_sql(keys), {p: r.spread("close") for p in periods}, finish)
        return _in_order(framed, [name for p in periods for name in bands[p]], rows.columns)

    return per_ticker(df, compute, max(periods), max_rows=max_rows, sized_by=sized_by)


def price_change(df: DataFrame, first: float | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """Add ``price_change`` against the previous bar; ``first`` replaces the leading NULL."""

    def compute(rows, keys):
        delta = r.change_sql("close", r.window_sql(keys))
        return _add(rows, {"price_change": delta if first is None else f"coalesce({delta}, {float(first)!r}D)"})

    return per_ticker(df, compute, 1, max_rows=max_rows)


def gain_loss(df: DataFrame) -> DataFrame:
    """Split ``price_change`` into non-negative ``gain`` and ``loss``."""
    return _add(df, {"gain": r.gain_sql("price_change"), "loss": r.loss_sql("price_change")})


def rsi(
    df: DataFrame,
    periods: Sequence[int] = s.RSI_PERIODS,
    zero_loss: str = "gain",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Relative strength index from plain means of gains and losses over ``p`` bars."""
    if zero_loss not in ("gain", "hundred"):
        raise ValueError(f"zero_loss must be 'gain' or 'hundred', not {zero_loss!r}")

    def finish(part: DataFrame, p: int) -> DataFrame:
        return _rounded(part, {s.rsi_name(p): r.rsi_sql(p, zero_loss)})

    def compute(rows, keys):
        w = r.window_sql(keys)
        moving = _add(rows, {"_delta": r.change_sql("close", w)})
        framed = r.with_frames(moving, w, {p: r.moves("_delta") for p in periods}, finish)
        return _in_order(framed, [s.rsi_name(p) for p in periods], rows.columns)

    return per_ticker(df, compute, max(periods), max_rows=max_rows)


def lookback(ma_periods=s.MA_PERIODS, band_periods=s.BAND_PERIODS, rsi_periods=s.RSI_PERIODS) -> int:
    """Earlier bars that one bar's indicators depend on (a change needs one more)."""
    return max(max(ma_periods) - 1, max(band_periods) - 1, max(rsi_periods))


def technical_columns(rows: DataFrame, keys: Sequence[str], families: Sequence[str] = s.FAMILIES) -> DataFrame:
    """All indicators of the families in one pass over one sort, frames shared between them."""
    w, seed = r.window_sql(keys), "newest"
    periods = {"averages": s.MA_PERIODS, "bands": s.BAND_PERIODS, "strength": s.RSI_PERIODS}
    ma, bb, ri = ([p for p in periods[f] if f in families] for f in s.FAMILIES)
    wanted: dict[int, dict[str, r.Measure]] = {}
    for p in ma:
        wanted[p] = r.count_and_sum("close") | r.weighted("close", p, seed)
    for p in bb:  # the bands lie around the exponential average
        wanted[p] = wanted.get(p, {}) | r.weighted("close", p, seed) | r.spread("close")
    for p in ri:
        wanted[p] = wanted.get(p, {}) | r.moves("_delta")

    def finish(part: DataFrame, p: int) -> DataFrame:
        raw, bands = {}, {}
        if p in ma:
            raw[f"ma_{s.sma_name(p)}"] = r.mean_sql(p)
        if p in ma or p in bb:
            raw[f"ma_{s.ema_name(p)}"] = r.ema_sql(p, seed)
        if p in ri:
            raw[s.rsi_name(p)] = r.rsi_sql(p)
        part = _rounded(part, raw)
        if p in bb:
            names = f"bb_{s.upper_name(p)}", f"bb_{s.lower_name(p)}"
            bands = _bands(f"`ma_{s.ema_name(p)}`", r.stddev_sql(p), *names)
        return _rounded(part, bands)

    moving = _add(rows, {"_delta": r.change_sql("close", w)}) if ri else rows
    framed = r.with_frames(moving, w, wanted, finish)
    return _in_order(framed, s.columns_of(families), rows.columns)


def rsi_zone(df: DataFrame, rsi_column: str, zone: str = "zone") -> DataFrame:
    """Label each bar overbought (above 70), oversold (below 30) or neutral."""
    value = F.col(f"`{rsi_column}`")
    return df.withColumn(
        zone,
        F.when(value > s.OVERBOUGHT, "overbought").when(value < s.OVERSOLD, "oversold").otherwise("neutral"),
    )
