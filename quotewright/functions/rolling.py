"""Rolling measures over one ticker's bars, in O(log p) work per row.

A frame is the current row and the ``p - 1`` rows before it; frames at the start of
the history are shorter and are kept.  Spark re-reads all ``p`` rows of a moving
frame for every row, so long frames are built from shorter ones instead: the frame
of 2k rows is the frame of k rows merged with the one ending k rows earlier, which
``lag`` supplies.  Every step uses the same window, hence one shuffle and one sort
for all periods.  Merging only adds, never subtracts, so a frame without movement
is exactly zero and nothing drifts along a long history.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quotewright.schemas import ORDER


def window_sql(keys: Sequence[str], order: Sequence[str] = ORDER) -> str:
    """The window all rolling expressions of one series share."""
    return f"(partition by {', '.join(keys)} order by {', '.join(order)})"


@dataclass(frozen=True)
class Measure:
    """One field of a frame, as SQL: its value for one row and for no row, and the
    merge of an older frame with a newer one.

    ``merge`` gets the names of both structs and the rows a complete older one has.
    """

    single: str
    none: str
    merge: Callable[[str, str, int], str]


def _total(name: str) -> Callable[[str, str, int], str]:
    return lambda older, newer, _: f"{older}.{name} + {newer}.{name}"


def count_and_sum(value: str) -> dict[str, Measure]:
    """Number and sum of the non-NULL values."""
    return {
        "n": Measure(f"if({value} is null, 0, 1)", "0", _total("n")),
        "sum": Measure(f"coalesce({value}, 0D)", "0D", _total("sum")),
    }


def spread(value: str) -> dict[str, Measure]:
    """Count, sum and the sum of squared deviations from the mean."""

    def merge(older: str, newer: str, _: int) -> str:
        gap = f"({newer}.sum / {newer}.n - {older}.sum / {older}.n)"
        share = f"({older}.n * {newer}.n / ({older}.n + {newer}.n))"
        between = f"if({older}.n = 0 or {newer}.n = 0, 0D, {gap} * {gap} * {share})"
        return f"{older}.spread + {newer}.spread + {between}"

    return count_and_sum(value) | {"spread": Measure("0D", "0D", merge)}


def alpha(p: int) -> float:
    return 2 / (p + 1)


def _power(base: float, count: str, usual: int) -> str:
    """``base ** count``, without a power call for complete frames."""
    return f"if({count} = {usual}, {base**usual!r}D, pow({base!r}D, {count}))"


def weighted(value: str, p: int, seed: str) -> dict[str, Measure]:
    """Sum of the values times powers of ``1 - alpha``, the count and the seed value.

    The power counts up from the oldest value for ``seed="newest"`` (the recursion
    starts at the newest and ends at the oldest value), down to the newest otherwise.
    """
    base, name = 1 - alpha(p), f"weighted_{p}"
    picks = {"newest": ("newer", "older"), "oldest": ("older", "newer")}[seed]

    def merge(older: str, newer: str, usual: int) -> str:
        if seed == "newest":
            return f"{older}.{name} + {_power(base, older + '.n', usual)} * {newer}.{name}"
        return f"{older}.{name} * pow({base!r}D, {newer}.n) + {newer}.{name}"

    def pick(older: str, newer: str, _: int) -> str:
        sides = {"older": older, "newer": newer}
        return f"coalesce({sides[picks[0]]}.{seed}, {sides[picks[1]]}.{seed})"

    return {
        "n": count_and_sum(value)["n"],
        seed: Measure(value, "cast(null as double)", pick),
        name: Measure(f"coalesce({value}, 0D)", "0D", merge),
    }


def gain_sql(delta: str) -> str:
    """The rise of a change, 0 for a fall and for a missing change."""
    return f"if({delta} > 0D, {delta}, 0D)"


def loss_sql(delta: str) -> str:
    return f"if({delta} < 0D, -{delta}, 0D)"


def moves(delta: str) -> dict[str, Measure]:
    """Rows in the frame and the sums of gains and losses."""
    return {
        "rows": Measure("1", "0", _total("rows")),
        "gain": Measure(gain_sql(delta), "0D", _total("gain")),
        "loss": Measure(loss_sql(delta), "0D", _total("loss")),
    }


def _struct(fields: Mapping[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def frame(p: int) -> str:
    return f"_frame_{p}"


def with_frames(
    rows: DataFrame,
    window: str,
    wanted: Mapping[int, Mapping[str, Measure]],
    finish: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """Build the frame of each period and let ``finish(rows, p)`` add columns from it.

    Step k holds the frame of k rows of every row.  A period whose binary form has
    bit k appends that frame behind the rows it has gathered so far; the finished
    frame is a struct ``_frame_{p}`` with the measures wanted for it.  Each period is
    finished one step after its last merge: that drops the struct early and keeps
    the code Spark generates per step small enough for the JVM to compile.
    """

    def needed(size: int) -> dict[str, Measure]:
        return {name: m for p, measures in wanted.items() if p >= size for name, m in measures.items()}

    def merged(older: str, newer: str, measures: Mapping[str, Measure], usual: int) -> str:
        return _struct({name: m.merge(older, newer, usual) for name, m in measures.items()})

    def finished(rows: DataFrame, periods: Sequence[int]) -> DataFrame:
        for p in periods:
            rows = finish(rows, p).drop(frame(p))
        return rows

    rows = rows.selectExpr("*", _struct({name: m.single for name, m in needed(1).items()}) + " as _run")
    size, ready = 1, []
    while size <= max(wanted):
        measures, doubled = needed(size), needed(2 * size)
        nothing = _struct({name: m.none for name, m in measures.items()})
        joining = [p for p in wanted if p & size]
        lags = {f"_behind_{p}": p % size for p in joining if p % size}
        if doubled:
            lags["_back"] = size
        rows = rows.selectExpr(
            "*", *[f"lag(_run, {offset}, {nothing}) over {window} as {name}" for name, offset in lags.items()]
        )
        step = {}
        for p in joining:
            if p % size:
                step[frame(p)] = merged(f"_behind_{p}", frame(p), wanted[p], size)
            else:
                step[frame(p)] = _struct({name: f"_run.{name}" for name in wanted[p]})
        if doubled:
            step["_run"] = merged("_back", "_run", doubled, size)
        replaced = {"_run", *step, *lags}
        kept = [f"`{c}`" for c in rows.columns if c not in replaced]
        rows = rows.selectExpr(*kept, *[f"{sql} as {name}" for name, sql in step.items()])
        rows = finished(rows, ready)
        ready = [p for p in joining if p < 2 * size]
        size *= 2
    return finished(rows, ready)


# Results from a frame struct, as SQL.


def mean_sql(p: int) -> str:
    return f"try_divide({frame(p)}.sum, {frame(p)}.n)"


def stddev_sql(p: int) -> str:
    """Sample standard deviation; NULL for fewer than two values."""
    return f"if({frame(p)}.n > 1, sqrt({frame(p)}.spread / ({frame(p)}.n - 1)), null)"


def ema_sql(p: int, seed: str) -> str:
    """Exponential average of the frame, seeded with its newest or oldest value.

    All values carry alpha times their power, except the seed, which carries the
    power alone.  NULL without values.
    """
    f = frame(p)
    return f"{alpha(p)!r}D * {f}.weighted_{p} + {_power(1 - alpha(p), f + '.n', p)} * {f}.{seed}"


def change_sql(value: str, window: str) -> str:
    """Difference to the previous bar; NULL on the first."""
    return f"{value} - lag({value}, 1) over {window}"


def rsi_sql(p: int, zero_loss: str = "gain") -> str:
    """Relative strength index from the mean gain and mean loss of a frame.

    With no loss in the frame the ratio is undefined.  ``zero_loss="gain"`` uses the
    mean gain itself as the ratio; ``zero_loss="hundred"`` gives the textbook 100.
    A frame without any movement is 100 in both, a frame without gains 0.
    """
    f = frame(p)
    lossless = "100D" if zero_loss == "hundred" else f"100D - 100D / (1D + {f}.gain / {f}.rows)"
    return (
        f"case when {f}.loss <> 0D then 100D - 100D / (1D + try_divide({f}.gain, {f}.loss)) "
        f"when {f}.gain <> 0D then {lossless} else 100D end"
    )
