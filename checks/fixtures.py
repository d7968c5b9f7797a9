"""Price-like views over the given tables; the SQL twins are in ``sql_views``.

Every view covers its whole source tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotewright.operators.chunks import MAX_ROWS, split_oversized
from quotewright.sources.readers import price_id

# Fixed values shared with the SQL: request range, reference day, incremental cuts.
START, END = "1998-01-01", "1999-12-31"
AS_OF = "2001-11-04"
STORED_BEFORE = "2001-01-01"
LANDED_FROM = "2000-12-01"
SLID_TO = "2007-08-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: line items of one supplier on one day; one row per stock and date."""
    # Few lines share a bar, so the lines are shuffled as they are: partial results of each would be several times as wide.
    return _bars_of(spark, sf_dir, lambda lines: lines.repartition("stock_id", "date"))


def placed_bars(spark: SparkSession, sf_dir: str, max_rows: int = MAX_ROWS) -> tuple[DataFrame, int | None]:
    """The bars, dealt by stock into as many partitions as the number says.

    A stock has at most as many bars as lines, which are counted without making the bars.  Lines
    shuffled by stock make bars by stock, so nothing after them is shuffled again.  Where a
    stock has more than ``max_rows`` lines the bars are spread as in ``bars``, and there is no number.
    """
    parts = _parts_by_stock(spark, sf_dir, max_rows)
    if parts is None:
        return bars(spark, sf_dir), None
    return _bars_of(spark, sf_dir, lambda items: items.repartition(parts, "stock_id")), parts


def placed_ticks(spark: SparkSession, sf_dir: str, max_rows: int = MAX_ROWS) -> tuple[DataFrame, int | None]:
    """``tick_prices``, dealt by stock likewise."""
    rows, parts = tick_prices(spark, sf_dir), _parts_by_stock(spark, sf_dir, max_rows)
    return (rows if parts is None else rows.repartition(parts, "stock_id")), parts


def _parts_by_stock(spark: SparkSession, sf_dir: str, max_rows: int) -> int | None:
    """Partitions to deal rows of line items into by stock, if no stock is oversized."""
    stock = F.col("l_suppkey").cast("string").alias("stock_id")
    lines = split_oversized(table(spark, sf_dir, "lineitem").select(stock), ["stock_id"], max_rows)
    if lines.hot is not None:
        return None
    # A join by stock and more may then use that all rows of a stock are in one partition.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.whole_rows // max_rows))


def _bars_of(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    day = F.col("l_shipdate").cast("date").alias("date")
    stock = F.col("l_suppkey").cast("string").alias("stock_id")
    items = table(spark, sf_dir, "lineitem").select(stock, day, "l_quantity", *line)
    daily = deal(items).groupBy("stock_id", "date").agg(
        F.min("l_extendedprice").alias("low"),
        F.min(F.struct(*line))["l_extendedprice"].alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.max(F.struct(*line))["l_extendedprice"].alias("close"),
    )
    stocks = table(spark, sf_dir, "supplier")
    named = stocks.select(F.col("s_suppkey").cast("string").alias("stock_id"), F.col("s_name").alias("ticker_symbol"))
    return daily.join(named, "stock_id").select(
        price_id(F.col("stock_id"), F.col("date")).alias("transaction_id"),
        "stock_id",
        "ticker_symbol",
        "date",
        "low",
        "open",
        "high",
        "volume",
        "close",
    )


def chart_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chart document per ticker and year, from its bars."""
    names = ["low", "open", "high", "close", "volume"]
    slot = F.struct(F.unix_timestamp(F.col("date").cast("timestamp")).alias("ts"), *names)
    yearly = bars(spark, sf_dir).groupBy("stock_id", "ticker_symbol", F.year("date").alias("year"))
    slots = yearly.agg(F.sort_array(F.collect_list(slot)).alias("slots"))
    quote = F.struct(*[F.col(f"slots.{n}").alias(n) for n in names])
    result = F.struct(
        F.col("slots.ts").alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators")
    )
    chart = F.struct(F.struct(F.array(result).alias("result")).alias("chart"))
    text = F.to_json(F.struct(chart["chart"].alias("chart")))
    return slots.select("stock_id", "ticker_symbol", text.alias("chart_json"))


def tick_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price rows: several closes of a stock on one day."""
    rows = ticks(spark, sf_dir)
    return rows.withColumns({name: F.col("close") for name in ("low", "open", "high")})


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty prices: one row per line item, with repeated closes and missing volumes."""
    items = table(spark, sf_dir, "lineitem")
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    key = F.concat_ws(":", *[F.col(c).cast("bigint" if c != "l_extendedprice" else "decimal(18,2)") for c in line])
    stocks = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("ticker_symbol"))
    named = items.join(stocks, items["l_suppkey"] == stocks["s_suppkey"])
    volume = F.col("l_quantity").cast("bigint") % 7
    return named.select(
        key.alias("transaction_id"),
        F.col("l_suppkey").cast("string").alias("stock_id"),
        "ticker_symbol",
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(volume != 0, volume).alias("volume"),
        F.col("l_quantity").alias("close"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    located = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    category = (F.col("s_suppkey") % 5).cast("string")
    return located.select(
        F.col("s_suppkey").cast("string").alias("stock_id"),
        F.col("s_name").alias("ticker_symbol"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("exchange"),
        F.when(category != "0", category).alias("category_name"),
        (F.col("s_acctbal") >= 5000).alias("technical"),
        F.col("n_regionkey").alias("region"),
    )


def watchlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
    return lists.select(
        F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority").alias("watchlist_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("watchlist_name"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    pairs = (
        orders.join(items, orders["o_orderkey"] == items["l_orderkey"])
        .select("o_custkey", "o_orderpriority", "l_suppkey")
        .distinct()
    )
    stocks = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return pairs.join(stocks, pairs["l_suppkey"] == stocks["s_suppkey"]).select(
        F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority").alias("watchlist_id"),
        F.col("l_suppkey").cast("string").alias("stock_id"),
        F.col("s_name").alias("ticker_symbol"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per company, one per company under a wrong country, one per unknown ticker."""
    known = companies(spark, sf_dir).select("ticker_symbol", "country", "exchange", "technical")
    right = known.select("ticker_symbol", "country", "technical")
    wrong = known.select("ticker_symbol", F.col("exchange").alias("country"), "technical")
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    unknown = customers.select(
        F.col("c_name").alias("ticker_symbol"), F.col("n_name").alias("country"), F.lit(True).alias("technical")
    )
    every = right.unionByName(wrong).unionByName(unknown)
    return every.select(
        "ticker_symbol",
        "country",
        F.lit(START).cast("date").alias("start_date"),
        F.lit(END).cast("date").alias("end_date"),
        "technical",
    )


def open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per company: by region closed, open at either side or both, or empty."""
    asked = companies(spark, sf_dir)
    start = F.when(F.col("region").isin(0, 2, 4), F.make_date(F.lit(1996) + F.col("region"), F.lit(3), F.lit(1)))
    end = F.when(F.col("region").isin(1, 2), F.make_date(F.lit(1997) + F.col("region"), F.lit(7), F.lit(31)))
    return asked.select("ticker_symbol", "country", start.alias("start_date"), end.alias("end_date"), "technical")
