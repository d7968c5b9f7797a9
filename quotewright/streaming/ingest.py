"""Incremental ingest of landed price files."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quotewright import schemas as s
from quotewright.operators.cleaning import drop_copies
from quotewright.sources import writers

BAR_KEY = ("stock_id", "date")
_STORED = T.StructType([*s.PRICES, T.StructField("year", T.IntegerType())])


def create_sink(spark: SparkSession, sink: str, prices: DataFrame | None = None) -> None:
    """Start the price table, split by year, with the given rows or none."""
    rows = spark.createDataFrame([], s.PRICES) if prices is None else s.conform(prices, s.PRICES)
    by_year = rows.withColumn("year", F.year("date")).repartitionByRange("year", "stock_id", "date")
    by_year.write.mode("ignore").partitionBy("year").parquet(sink)


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(sink)


def append_new(batch: DataFrame, sink: str, key: Sequence[str] = BAR_KEY, rejects: str | None = None) -> None:
    """Append the bars of ``batch`` whose key the sink lacks.

    Comparing with the sink, rather than with a watermarked state, lets a replayed
    batch add nothing and a late bar still arrive.  Only the span of years of the batch
    is read back.  Bars without a full key go to the folder ``rejects``, replacing what a
    replay left there; without one they fail the batch.
    """
    rows = writers.persisted(s.conform(batch, s.PRICES), "batch")
    keyless = functools.reduce(Column.__or__, [F.col(k).isNull() for k in key])
    found = rows.agg(
        F.min("date").alias("first"), F.max("date").alias("last"), F.count_if(keyless).alias("keyless")
    ).first()
    if found["keyless"]:
        if rejects is None:
            raise ValueError(f"{found['keyless']} bars lack one of {', '.join(key)}")
        rows.filter(keyless).write.mode("overwrite").parquet(rejects)
    if found["first"] is None:
        return
    stored = read_sink(batch.sparkSession, sink).filter(
        F.col("year").between(found["first"].year, found["last"].year)
    )
    new = drop_copies(rows.filter(~keyless), key).join(stored.select(*key), list(key), "left_anti")
    writers.append_by_year(new, sink)


def ingest_landed(
    spark: SparkSession, landing: str, sink: str, checkpoint: str, files_per_batch: int = 1000, rejects: str | None = None
):
    """Drain the landing folder into the sink and stop; run again for files landed since.

    The checkpoint remembers which files were taken, also across restarts.  Rejected bars
    are kept under ``rejects``, one folder per batch (``batch=<id>``).
    """
    landed = spark.readStream.schema(s.PRICES).option("maxFilesPerTrigger", files_per_batch).parquet(landing)

    def take(batch: DataFrame, number: int) -> None:
        append_new(batch, sink, rejects=None if rejects is None else f"{rejects}/batch={number}")

    query = (
        landed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
