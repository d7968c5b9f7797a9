"""Sinks and saved tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from quotewright import schemas as s

from quotewright.sources.storage import fresh_path

# Keys handed to every executor, counted (as for joins, see operators/chunks.py).
MAX_BROADCAST_KEYS = 200_000

# Saved copies and tables by year hold doubles that change little from day to day: a fifth to a third smaller than by default.
COMPACT = {"compression": "zstd"}


def overwrite(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace a parquet table by ``df`` in the given layout."""
    s.conform(df, schema).write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Append ``df`` in the given layout; the rows written, counted during the write."""
    written = Observation("appended")
    s.conform(df, schema).observe(written, F.count("*").alias("rows")).write.mode("append").parquet(path)
    return written.get["rows"]


class BadBatch(ValueError):
    """A batch that was not published, with what was measured."""

    def __init__(self, batch: str, measured: Mapping[str, int]) -> None:
        super().__init__(f"batch {batch} was not published: {dict(measured)}")
        self.measured = dict(measured)


def publish_batch(
    df: DataFrame, path: str, batch: str, schema: T.StructType, unique: Sequence[str], required: Sequence[str] = ()
) -> dict[str, int]:
    """Add a batch to a table of folders ``batch=<name>`` if its rows are sound; what was measured.

    Rows, rows that repeat the key ``unique`` and rows without a value of ``required`` (by default,
    of the key) are counted by the job that writes the batch beside the table.  Only a
    sound batch is moved into it, by renaming one folder; of another the table shows nothing.
    A batch that is there already stays as it is, so a replay adds nothing.
    """
    spark = df.sparkSession
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs, target = of(path).getFileSystem(spark._jsc.hadoopConfiguration()), of(f"{path}/batch={batch}")
    if fs.exists(target):
        return {"rows": 0, "repeated": 0, "missing": 0}
    measured = Observation("batch")
    rank = F.row_number().over(Window.partitionBy(*unique).orderBy(F.lit(0)))
    lacking = functools.reduce(Column.__or__, [F.col(c).isNull() for c in required or unique])
    rows = s.conform(df, schema).withColumn("_rank", rank).observe(
        measured,
        F.count("*").alias("rows"),
        F.count_if(F.col("_rank") > 1).alias("repeated"),
        F.count_if(lacking).alias("missing"),
    )
    staged = f"{path}/_staged-{uuid.uuid4().hex}"  # readers pass over names that begin so
    rows.drop("_rank").write.parquet(staged)
    found = dict(measured.get)
    if found["repeated"] or found["missing"]:
        fs.delete(of(staged), True)
        raise BadBatch(batch, found)
    if not fs.rename(of(staged), target):
        raise OSError(f"batch {batch} could not be moved into {path}")
    return found


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The published batches, with the column ``batch`` last."""
    return spark.read.schema(T.StructType([*schema, T.StructField("batch", s.STRING)])).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append") -> None:
    df.write.jdbc(url, table, mode=mode, properties=dict(properties))


def save(df: DataFrame, path: str) -> None:
    """Write rows to a new folder."""
    df.write.options(**COMPACT).parquet(path)


def persisted(df: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Several sinks can then use it without computing it again, and a lost executor
    costs a re-read, not a recomputation.  ``buckets`` says that the rows are dealt by stock
    into as many partitions: they are saved as so many buckets, which joins and frames by stock
    use without a shuffle.
    """
    path = fresh_path(df.sparkSession, name)
    if buckets is None:
        save(df, path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    saved = save_bucketed(df, table, path, buckets, ["stock_id"], placed=True)
    drop_view(df.sparkSession, table)  # out of the catalog; its files stay
    return saved


def save_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    on: Sequence[str] = tuple(s.ROW_KEY),
    placed: bool = False,
) -> DataFrame:
    """Save as a table bucketed and sorted by the join keys.

    Tables saved alike join on those keys without a shuffle.  The usual keys include the
    date, so a hot stock is spread over all buckets.  ``placed`` says that the rows
    are already dealt by these keys into as many partitions and need no shuffle.
    """
    rows = df if placed else df.repartition(buckets, *on)
    (
        rows.write.mode("overwrite")
        .options(**COMPACT)
        .option("path", path)
        .bucketBy(buckets, *on)
        .sortBy(*on)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def append_bucketed(df: DataFrame, table: str, schema: T.StructType, buckets: int, on: Sequence[str]) -> int:
    """Append rows that are dealt by ``on`` into as many partitions to a table of the session's
    catalog, bucketed alike; the rows written.  A table that is not there is created in a new folder."""
    spark, written = df.sparkSession, Observation("appended")
    writer = s.conform(df, schema).observe(written, F.count("*").alias("rows")).write.mode("append")
    if not spark.catalog.tableExists(table):
        writer = writer.option("path", fresh_path(spark, table))
    writer.bucketBy(buckets, *on).sortBy(*on).saveAsTable(table)
    return written.get["rows"]


def save_view(view: DataFrame, path: str, placed: bool = False) -> DataFrame:
    """Save the technical view for lookups by stock and by date.

    Files are split by year for pruning by date; within a year rows are ranged by
    stock, so the files' minima and maxima exclude most of them for one stock.  ``placed`` says
    that the rows come in buckets of stocks; they stay there, and the pages' minima and maxima
    inside the sorted files do the same.  The
    result keeps the column ``year``: reads that also bound it open only those folders.
    """
    yearly = view.withColumn("year", F.year("date"))
    (
        (yearly if placed else yearly.repartitionByRange("year", "stock_id", "date"))
        .sortWithinPartitions("year", "stock_id", "date")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )
    return view.sparkSession.read.schema(yearly.schema).parquet(path)


def _by_year(df: DataFrame) -> DataFrame:
    """Rows with their year, sorted for files of one year by stock; they stay in their partitions,
    so writing them costs no shuffle and computes them once."""
    return df.withColumn("year", F.year("date")).sortWithinPartitions("year", "stock_id", "date")


def create_by_year(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty table split by year."""
    empty = spark.createDataFrame([], schema).withColumn("year", F.year("date"))
    empty.write.mode("ignore").partitionBy("year").parquet(path)


def read_by_year(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table split by year, with the column ``year`` last."""
    return spark.read.schema(T.StructType([*schema, T.StructField("year", T.IntegerType())])).parquet(path)


def append_by_year(df: DataFrame, path: str) -> int:
    """Append rows to a table split by year; the rows written."""
    written = Observation("appended")
    counted = _by_year(df).observe(written, F.count("*").alias("rows"))
    counted.write.mode("append").options(**COMPACT).partitionBy("year").parquet(path)
    return written.get["rows"]


def upsert_by_year(df: DataFrame, path: str, key: str, saved: bool = False) -> int:
    """Insert rows into a table split by year, replacing those with the same key; the rows
    given.  Only years that hold such rows are written anew, the others are appended to.

    ``saved`` says that the rows come from files and need no copy.  Years are replaced when
    all of them are written, so they may be read from the table itself.
    """
    spark = df.sparkSession
    rows = df.withColumn("year", F.year("date"))
    rows = rows if saved else persisted(rows, "changes")
    given = rows.count()
    keys = rows.select(key)
    keys = F.broadcast(keys) if given <= MAX_BROADCAST_KEYS else keys
    stored = spark.read.schema(rows.schema).parquet(path)
    touched = rows.select("year").distinct()
    known = stored.join(F.broadcast(touched), stored["year"].eqNullSafe(touched["year"]), "left_semi")  # a few years
    replaced = known.join(keys, key, "left_semi").select("year").distinct()
    replaced = [r["year"] for r in replaced.collect()]  # a few years
    anew = in_years(replaced)
    old, fresh = rows.filter(anew), rows.filter(~anew)
    if replaced:
        kept = stored.filter(anew).join(keys, key, "left_anti")
        whole = kept.select(*[f"`{c}`" for c in rows.columns]).unionByName(old)
        overwrite_years(whole, path)
    _by_year(fresh).write.mode("append").options(**COMPACT).partitionBy("year").parquet(path)
    return given


def overwrite_years(rows: DataFrame, path: str) -> None:
    """Replace the years that the rows lie in; Spark moves them into place when all are written."""
    placed = rows.sortWithinPartitions("year", "stock_id", "date")
    writer = placed.write.mode("overwrite").options(**COMPACT).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year").parquet(path)


def in_years(years: Sequence[int | None]) -> Column:
    """A condition on ``year``, null for rows without a date: it is one of these."""
    inside = F.col("year").isin([y for y in years if y is not None])
    return F.when(F.col("year").isNull(), F.lit(None in years)).otherwise(inside)


def drop_years(spark: SparkSession, path: str, which: Column) -> list[str]:
    """Remove the folders of some years of a table split by year: a condition on ``year``, null
    for rows without a date.  The folders' names are returned."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [x.getPath().getName() for x in fs.listStatus(fs_path(path)) if x.isDirectory() and x.getPath().getName().startswith("year=")]
    named = [(name, int(name[5:]) if name[5:].isdigit() else None) for name in folders]
    rows = spark.createDataFrame(named, "folder string, year int").filter(which)
    gone = [r["folder"] for r in rows.collect()]  # years
    for name in gone:
        fs.delete(fs_path(f"{path}/{name}"), True)
    return gone


def keep_in_year(stored: DataFrame, path: str, year: int, keep: Column) -> None:
    """Write one year of a table split by year anew with only the rows to keep."""
    spark = stored.sparkSession
    kept = stored.filter((F.col("year") == year) & keep)
    if kept.isEmpty():
        drop_years(spark, path, F.col("year") == year)
        return
    overwrite_years(kept, path)


def drop_view(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def export_per_ticker(
    prices: DataFrame, path: str, max_rows_per_file: int = 1_000_000, placed: bool = False
) -> None:
    """CSV with header, one folder per ticker, rows by date.

    The range shuffle gathers a ticker into few files but may cut a very long one;
    file names sort in date order within a folder.  ``placed`` says that every ticker is in one
    partition, none oversized: the rows stay there.
    """
    columns = ["ticker_symbol", "transaction_id", "date", "low", "open", "high", "volume", "close"]
    rows = prices.select(*columns)
    (
        (rows if placed else rows.repartitionByRange("ticker_symbol", "date", "transaction_id"))
        .sortWithinPartitions("ticker_symbol", "date", "transaction_id")
        .write.mode("overwrite")
        .partitionBy("ticker_symbol")
        .option("header", True)
        .option("maxRecordsPerFile", max_rows_per_file)
        .csv(path)
    )


def export_combined(prices: DataFrame, path: str) -> None:
    """All tickers as CSV with header, in the fixed column order."""
    prices.select(*s.PRICES.fieldNames()).write.mode("overwrite").option("header", True).csv(path)


def read_export_combined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(s.PRICES).option("header", True).option("mode", "FAILFAST").csv(path)


def read_export_per_ticker(spark: SparkSession, path: str) -> DataFrame:
    """The per-ticker files read back; the ticker comes from the folder name."""
    fields = [f for f in s.PRICES if f.name not in ("stock_id", "ticker_symbol")]
    schema = T.StructType([*fields, T.StructField("ticker_symbol", s.STRING)])
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


