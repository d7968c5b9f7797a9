"""Table layouts and the fixed parameters of the indicator set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The periods (in bars) of each indicator and the band width.
MA_PERIODS = [5, 20, 50, 200]
BAND_PERIODS = [5, 20, 50, 200]
RSI_PERIODS = [14, 20, 50, 200]
BAND_WIDTH = 2

# RSI zone limits, the horizon of the technical view, the default text.
OVERBOUGHT = 70
OVERSOLD = 30
VIEW_DAYS = 3650
UNKNOWN = "UNKNOWN"

# One time series is one (stock_id, ticker_symbol); ids break ties within a date.
TICKER = ["stock_id", "ticker_symbol"]
ORDER = ["date", "transaction_id"]
# What tells stored rows apart and places them: the id is unique, the others spread and prune.
ROW_KEY = ["stock_id", "date", "transaction_id"]

STRING, DATE, DOUBLE, LONG = T.StringType(), T.DateType(), T.DoubleType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PRICES = _schema(
    ("transaction_id", STRING), ("stock_id", STRING), ("ticker_symbol", STRING), ("date", DATE),
    ("low", DOUBLE), ("open", DOUBLE), ("high", DOUBLE), ("volume", LONG), ("close", DOUBLE),
)
# One ticker's file or rows: no ids of the stock, which the caller attaches.
BARS = _schema(
    ("date", DATE), ("low", DOUBLE), ("open", DOUBLE), ("high", DOUBLE),
    ("volume", LONG), ("close", DOUBLE),
)
COMPANIES = _schema(
    ("stock_id", STRING), ("ticker_symbol", STRING), ("company_name", STRING),
    ("exchange", STRING), ("category_name", STRING), ("country", STRING),
)
COMPANY_SHEET = _schema(
    ("ticker_symbol", STRING), ("company_name", STRING), ("exchange", STRING),
    ("category_name", STRING), ("country", STRING),
)
WATCHLISTS = _schema(("watchlist_id", STRING), ("user_id", LONG), ("watchlist_name", STRING))
MEMBERS = _schema(("watchlist_id", STRING), ("stock_id", STRING), ("ticker_symbol", STRING))
COVERAGE = _schema(("view_name", STRING), ("start_date", DATE), ("end_date", DATE))
REQUESTS = _schema(
    ("ticker_symbol", STRING), ("country", STRING), ("start_date", DATE), ("end_date", DATE),
    ("technical", T.BooleanType()),
)

# The three stored indicator tables share their keys.
KEYS = ["cal_id", "transaction_id", "stock_id", "ticker_symbol", "date"]
_KEY_FIELDS = [(name, DATE if name == "date" else STRING) for name in KEYS]


def sma_name(p: int) -> str:
    return f"{p}_days_sma"


def ema_name(p: int) -> str:
    return f"{p}_days_ema"


def upper_name(p: int) -> str:
    return f"{p}_upper_band"


def lower_name(p: int) -> str:
    return f"{p}_lower_band"


def rsi_name(p: int) -> str:
    return f"{p}_days_rsi"


MA_COLUMNS = [sma_name(p) for p in MA_PERIODS] + [ema_name(p) for p in MA_PERIODS]
BAND_COLUMNS = [upper_name(p) for p in BAND_PERIODS] + [lower_name(p) for p in BAND_PERIODS]
RSI_COLUMNS = [rsi_name(p) for p in RSI_PERIODS]

MOVING_AVERAGES = _schema(*_KEY_FIELDS, *[(c, DOUBLE) for c in MA_COLUMNS])
BANDS = _schema(*_KEY_FIELDS, *[(c, DOUBLE) for c in BAND_COLUMNS])
RSI = _schema(*_KEY_FIELDS, *[(c, DOUBLE) for c in RSI_COLUMNS])

# The wide frame prefixes the two families that share period names.
WIDE_MA = {c: f"ma_{c}" for c in MA_COLUMNS}
WIDE_BANDS = {c: f"bb_{c}" for c in BAND_COLUMNS}
WIDE_COLUMNS = list(WIDE_MA.values()) + list(WIDE_BANDS.values()) + RSI_COLUMNS
# The wide columns by family, in their order.
_FAMILY_COLUMNS = {"averages": list(WIDE_MA.values()), "bands": list(WIDE_BANDS.values()), "strength": RSI_COLUMNS}
FAMILIES = tuple(_FAMILY_COLUMNS)
VIEW_COLUMNS = ["stock_id", "ticker_symbol", "date", "close", *WIDE_COLUMNS]
# The stored view also has the row's id, by which late bars replace rows.
VIEW = _schema(
    ("transaction_id", STRING), ("stock_id", STRING), ("ticker_symbol", STRING), ("date", DATE), ("close", DOUBLE),
    *[(c, DOUBLE) for c in WIDE_COLUMNS],
)


def columns_of(families) -> list[str]:
    """The wide columns of some families."""
    return [c for family in FAMILIES if family in families for c in _FAMILY_COLUMNS[family]]


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Project to exactly ``schema`` by casting each column.

    A plain projection keeps filters and column pruning reaching the scan.
    ``strict=False`` turns values that do not parse into NULL.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    return df.select(*[cast(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema])
