"""Fixed schemas and column orders."""

from pyspark.sql import types as T

# Raw trade file, one per symbol and day: ``{symbol}-trades-{yyyy-MM-dd}.csv``.
TRADE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("qty", T.DoubleType(), True),
        T.StructField("quote_qty", T.DoubleType(), True),
        T.StructField("time", T.LongType(), True),  # epoch milliseconds
        T.StructField("is_buyer_maker", T.BooleanType(), True),
    ]
)

RAW_TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]

# Columns a bar computation needs; ``date`` is carried when present.
REQUIRED_TRADE_COLUMNS = ["symbol", "ts", "price", "qty", "quote_qty", "is_buyer_maker", "id"]
OPTIONAL_TRADE_COLUMNS = ["date"]

# Prepared trades: raw columns plus the derived ones.
PREPARED_TRADE_COLUMNS = RAW_TRADE_COLUMNS + ["symbol", "date", "ts", "market"]

# One bar column order for filled and unfilled bars.
BAR_COLUMNS = [
    "symbol",
    "open_time",
    "close_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "vwap",
    "quote_volume",
    "taker_buy_volume",
    "taker_buy_quote_volume",
    "count",
]
BAR_COLUMNS_WITH_BUCKET = BAR_COLUMNS + ["bucket"]

# Columns compared against exchange klines: 8 doubles and the trade count.
KLINE_VALUE_COLUMNS = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_volume",
    "count",
    "taker_buy_volume",
    "taker_buy_quote_volume",
]

MANIFEST_ENTRY = T.StructType(
    [
        T.StructField("date", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("url", T.StringType(), True),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("market", T.StringType(), True),
        T.StructField("start", T.StringType(), True),
        T.StructField("end", T.StringType(), True),
        T.StructField("entries", T.ArrayType(MANIFEST_ENTRY), True),
    ]
)
