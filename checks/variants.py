"""Time alternative plans for the same measures on saved bars.

    python -m checks.variants [sf_dir]

Compares Spark's own moving frames (averages, deviations, mean gains and losses), which
are read anew for every row, with the merged frames of this library, and a bucketed with
a plain join of the stored tables.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Window, functions as F

from bench import session
from checks import fixtures as fx
from quotewright import schemas as s
from quotewright.functions.rolling import gain_sql, loss_sql
from quotewright.operators import indicators, technical
from quotewright.plans.batch import save_indicators
from quotewright.plans.indicators import technical_frame
from quotewright.sources import writers


def moving_frames(bars: DataFrame) -> DataFrame:
    """The plain means and deviations of every period with ``rows between``."""
    series = Window.partitionBy(*s.TICKER).orderBy(*s.ORDER)
    moves = bars.withColumn("delta", F.col("close") - F.lag("close").over(series))
    measures = {
        "mean": (s.MA_PERIODS, F.avg("close")),
        "deviation": (s.BAND_PERIODS, F.stddev_samp("close")),
        "gain": (s.RSI_PERIODS, F.avg(F.expr(gain_sql("delta")))),
        "loss": (s.RSI_PERIODS, F.avg(F.expr(loss_sql("delta")))),
    }
    return moves.withColumns(
        {f"{name}_{p}": value.over(series.rowsBetween(1 - p, 0)) for name, (periods, value) in measures.items() for p in periods}
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session(8)
    bars = writers.persisted(fx.bars(spark, sf_dir), "bars")
    spread = bars.repartition(8, *s.TICKER)

    def clock(label, build):
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        print(f"| {label} | {best:.1f} s |", flush=True)

    clock("simple averages: merged frames", lambda: indicators.sma(spread))
    clock("means, deviations, gains and losses: moving frames", lambda: moving_frames(spread))
    clock("all indicators (with exponential averages, cleaning, rounding): merged frames", lambda: technical_frame(bars))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = save_indicators(bars)

    def join():
        return technical.technical_join(t.prices, t.averages, t.bands, t.strength)

    clock("join of stored tables: bucketed", join)
    spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
    clock("join of stored tables: plain", join)
    spark.stop()


if __name__ == "__main__":
    main()
