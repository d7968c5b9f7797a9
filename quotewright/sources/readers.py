"""Price and company sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quotewright import schemas as s
from quotewright.functions.numeric import round2
from quotewright.sources import writers
from quotewright.sources.storage import fresh_path


def read_table(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """A saved table by name or a parquet folder by path, in the given layout."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return s.conform(df, schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: T.StructType,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table in the given layout.

    With a numeric or date ``partition_column`` and its bounds the read is split
    into ``partitions`` queries.  Casting by projection keeps filters pushing down.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return s.conform(reader.load(), schema)


def read_price_csv(spark: SparkSession, path: str, schema: T.StructType = s.BARS) -> DataFrame:
    """Price files with a header row; the schema is declared, not inferred.

    A value that doesn't parse fails the read instead of turning into NULL.
    """
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def split_price_csv(
    spark: SparkSession, path: str, schema: T.StructType = s.BARS, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Price files, read once: rows in the layout, and rejects.

    A reject has its line and a cause: ``fields`` for too few or too many fields, else the first
    column whose value doesn't parse.  An empty field is a missing value.  Rows and
    rejects come from one saved table and add up to the lines read.
    """
    fields = [T.StructField(f"_{f.name}", s.STRING) for f in schema]
    texts = spark.read.schema(T.StructType([*fields, T.StructField("_line", s.STRING)])).option("header", header)
    lines = texts.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path)
    cause = F.when(F.col("_line").isNotNull(), "fields")
    for f in schema:
        text = F.col(f"_{f.name}")
        cause = cause.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), f.name)
    values = [F.col(f"_{f.name}").try_cast(f.dataType).alias(f.name) for f in schema]
    whole = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(f"_{f.name}", F.lit("")) for f in schema]))
    saved = writers.persisted(lines.select(*values, whole.alias("_line"), cause.alias("_cause")), "csv_lines")
    rejects = saved.filter("_cause is not null").select(F.col("_line").alias("line"), F.col("_cause").alias("cause"))
    return saved.filter("_cause is null").select(*schema.fieldNames()), rejects


def price_rows(
    spark: SparkSession, rows: Iterable, stock_id: str, ticker_symbol: str, text: bool = False
) -> DataFrame:
    """In-memory bars of one stock; dates as ISO text.  ``text`` keeps every value as text."""
    names = ["transaction_id", "date", "low", "open", "high", "volume", "close"]
    kinds = {f.name: f.dataType for f in s.PRICES}
    fields = [T.StructField(n, s.STRING if text or n == "date" else kinds[n]) for n in names]
    typed = spark.createDataFrame(rows, T.StructType(fields))
    if not text:
        typed = typed.withColumn("date", F.to_date("date"))
    return typed.select(
        F.lit(stock_id).alias("stock_id"), F.lit(ticker_symbol).alias("ticker_symbol"), *names
    )


# The chart documents hold parallel arrays, one slot per day.
_QUOTE = "struct<low:array<double>,open:array<double>,high:array<double>,close:array<double>,volume:array<bigint>>"
CHART_SCHEMA = (
    f"struct<chart:struct<result:array<struct<timestamp:array<bigint>,indicators:struct<quote:array<{_QUOTE}>>>>>>"
)


def price_id(stock_id: Column, date: Column) -> Column:
    """A reproducible row id: one bar per stock and day."""
    return F.concat_ws(":", stock_id, date.cast("string"))


def explode_chart_json(documents: DataFrame, json_column: str = "chart_json") -> DataFrame:
    """One bar per day from chart documents (stock_id, ticker_symbol, JSON text).

    Epoch seconds become UTC dates and prices are rounded to cents.  A slot without
    a value stays NULL.  Sessions run in UTC, which is what makes the date a UTC date.
    Every result and every quote of a document is read; timestamps without a quote are bars without values.  A document that isn't JSON fails
    the read; one without bars (``chart_rejects``) has none.
    """
    parsed = F.from_json(F.col(json_column), CHART_SCHEMA, {"mode": "FAILFAST"})
    results = documents.select("stock_id", "ticker_symbol", F.explode(parsed["chart"]["result"]).alias("_result"))
    result = F.col("_result")
    quotes = results.select(
        "stock_id", "ticker_symbol", result["timestamp"].alias("_ts"), F.explode_outer(result["indicators"]["quote"]).alias("_quote")
    )
    nothing = F.array().cast("array<double>")
    slots = F.arrays_zip(
        F.col("_ts").alias("ts"),
        *[F.coalesce(F.col("_quote")[name], nothing).alias(name) for name in ("low", "open", "high", "volume", "close")],
    )
    bars = quotes.select("stock_id", "ticker_symbol", F.inline(slots))
    day = F.timestamp_seconds("ts").cast("date")
    return bars.select(
        price_id(F.col("stock_id"), day).alias("transaction_id"),
        "stock_id",
        "ticker_symbol",
        day.alias("date"),
        *[round2(c).alias(c) for c in ("low", "open", "high")],
        "volume",
        round2("close").alias("close"),
    )


def _chart_bars(json_column: str) -> Column:
    """The bars a chart document holds: 0 if it is missing, not JSON, or without a result's timestamps."""
    parsed = F.from_json(F.col(json_column), CHART_SCHEMA)
    bars = F.transform(parsed["chart"]["result"], lambda r: F.greatest(F.size(r["timestamp"]), F.lit(0)))
    return F.coalesce(F.aggregate(bars, F.lit(0), lambda total, n: total + n), F.lit(0))


def chart_rejects(documents: DataFrame, json_column: str = "chart_json") -> DataFrame:
    """Documents that hold no bars: missing, not JSON, or without a result's timestamps."""
    return documents.filter(_chart_bars(json_column) == 0)


def split_chart_documents(documents: DataFrame, json_column: str = "chart_json") -> tuple[DataFrame, DataFrame]:
    """Documents with bars, and ``chart_rejects``, from one saved table; ``documents`` is computed once.

    The two are folders of that table, so a read of the first, which fails on a document
    that isn't JSON, never opens the second.
    """
    spark, path = documents.sparkSession, fresh_path(documents.sparkSession, "documents")
    marked = documents.withColumn("_rejected", (_chart_bars(json_column) == 0).cast("int"))
    marked.write.partitionBy("_rejected").parquet(path)
    saved = spark.read.schema(marked.schema).parquet(path)
    return tuple(saved.filter(F.col("_rejected") == k).drop("_rejected") for k in (0, 1))


# Column names of vendor history files and ours.
HISTORY_COLUMNS = {"Low": "low", "Open": "open", "High": "high", "Volume": "volume", "Close": "close"}


def normalize_history(history: DataFrame, date_column: str = "Date") -> DataFrame:
    """Landed vendor history (Date, Open, High, Low, Close, Volume) as price rows."""
    day = F.to_date(F.col(date_column))
    values = {
        name: F.col(source).cast("bigint") if name == "volume" else round2(f"cast(`{source}` as double)")
        for source, name in HISTORY_COLUMNS.items()
    }
    return history.select(
        price_id(F.col("stock_id"), day).alias("transaction_id"),
        "stock_id",
        "ticker_symbol",
        day.alias("date"),
        *[value.alias(name) for name, value in values.items()],
    )


def read_company_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The first five columns of a company listing; its header row is not data."""
    listing = spark.read.schema(s.COMPANY_SHEET).option("header", True).option("enforceSchema", True)
    return listing.option("mode", "FAILFAST").csv(path)


def company_rows(sheet: DataFrame, stock_id: Column | None = None) -> DataFrame:
    """Companies with missing or empty text replaced and an id per row.

    The id is derived from the ticker and country, so a repeated read or task repeats it;
    another expression may be given.
    """
    texts = s.COMPANY_SHEET.fieldNames()
    filled = [F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit(s.UNKNOWN)).alias(c) for c in texts]
    rows = sheet.select(*([] if stock_id is None else [stock_id.alias("stock_id")]), *filled)
    if stock_id is None:
        rows = rows.withColumn("stock_id", F.md5(F.concat_ws("|", "ticker_symbol", "country")))
    return rows.select(*s.COMPANIES.fieldNames())


def split_symbols(requests: DataFrame, column: str = "ticker_symbols", keep: Sequence[str] = ()) -> DataFrame:
    """One row per symbol of a comma-separated list, trimmed, numbered from 0."""
    symbols = F.split(F.col(column), ",")
    return requests.select(*keep, F.posexplode(symbols).alias("position", "_symbol")).select(
        *keep, "position", F.trim("_symbol").alias("ticker_symbol")
    )
