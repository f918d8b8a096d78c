"""Trade views over the driver's tables.

The library works on trades (symbol, id, price, qty, quote_qty, ts, ...).
The test tables are not trades, so two fixed mappings turn them into trades;
the oracle SQL in ``tickforge.plans.catalog`` spells out the same mappings.

``events`` (unique ts and ids, 5 symbols over 30 days):
    symbol = 'PURCHASEUSD_PERP' for event type 'purchase' (a coin-margined
    name), else upper(event_type) || 'USDT'; id = event_id; price = value;
    qty = 1 + user_id % 10; quote_qty = price * qty; ts = ts;
    is_buyer_maker = event_id is even.

``lineitem`` (whole days, heavy ties; id is not unique):
    symbol = l_returnflag || l_linestatus; ts = l_shipdate;
    id = l_orderkey * 10 + l_linenumber; price = l_extendedprice / l_quantity;
    qty = l_quantity; quote_qty = l_extendedprice; is_buyer_maker = l_linenumber is even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

# Fixed values of the fixture mapping.
CM_EVENT_TYPE = "purchase"
CM_SYMBOL = "PURCHASEUSD_PERP"
UM_SUFFIX = "USDT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_symbol(event_type: Column) -> Column:
    return F.when(event_type == CM_EVENT_TYPE, F.lit(CM_SYMBOL)).otherwise(F.concat(F.upper(event_type), F.lit(UM_SUFFIX)))


# Fixed rules of the unclean rows, by event_id: (divisor, remainder).
NO_FLAG, NO_TIME, NO_QUOTE = (23, 6), (29, 8), (19, 4)
NULL_PRICE, NAN_PRICE, ZERO_PRICE = (11, 3), (13, 5), (17, 7)


def _when(rule: tuple[int, int]) -> Column:
    return F.col("event_id") % rule[0] == rule[1]


def events_trades(spark: SparkSession, sf_dir: str, maker_from: str = "event_id", gaps: bool = False, late_hours: int = 0) -> DataFrame:
    """Trades from ``events``: symbol, id, price, qty, quote_qty, is_buyer_maker, ts, date.

    ``maker_from="user_id"`` flags makers by even user_id instead (used to
    build a second, differing bar set for the comparison checks).  With ``gaps``
    some rows lack the maker flag or the time, or have quote quantity 0.
    ``late_hours`` moves the file date ahead of the time, so that the last
    hours of a day are in the next day's file."""
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    qty = (F.lit(1) + F.col("user_id") % 10).cast("double")
    return ev.select(
        event_symbol(F.col("event_type")).alias("symbol"),
        F.col("event_id").alias("id"),
        F.col("value").alias("price"),
        qty.alias("qty"),
        (F.when(_when(NO_QUOTE), 0.0).otherwise(F.col("value") * qty) if gaps else F.col("value") * qty).alias("quote_qty"),
        (F.when(~_when(NO_FLAG), F.col(maker_from) % 2 == 0) if gaps else F.col(maker_from) % 2 == 0).alias("is_buyer_maker"),
        (F.when(~_when(NO_TIME), F.col("ts")) if gaps else F.col("ts")).alias("ts"),
        F.to_date(F.col("ts") + F.expr(f"INTERVAL {int(late_hours)} HOURS")).alias("date"),
    )


def events_unclean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events_trades`` with gaps and prices that are null, NaN or 0, and ``time`` in milliseconds."""
    t = events_trades(spark, sf_dir, gaps=True)
    bad = lambda rule: F.col("id") % rule[0] == rule[1]
    price = F.when(bad(NULL_PRICE), None).when(bad(NAN_PRICE), float("nan")).when(bad(ZERO_PRICE), 0.0).otherwise(F.col("price"))
    return t.withColumn("price", price).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp")))


def raw_of(trades: DataFrame) -> DataFrame:
    """Raw trade rows with the path of the file each would come from."""
    path = F.concat(F.lit("file:///raw/"), F.col("symbol"), F.lit("-trades-"), F.col("date").cast("string"), F.lit(".csv"))
    return trades.select("id", "price", "qty", "quote_qty", "time", "is_buyer_maker", path.alias("file_path"))


def events_raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade rows from ``events`` as a trade file would hold them, plus the
    file path each row would come from: ``file:///raw/{symbol}-trades-{date}.csv``.
    ``time`` is epoch milliseconds (the raw format keeps ms)."""
    t = events_trades(spark, sf_dir)
    return t.select(
        "id",
        "price",
        "qty",
        "quote_qty",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        "is_buyer_maker",
        F.concat(F.lit("file:///raw/"), F.col("symbol"), F.lit("-trades-"), F.col("date").cast("string"), F.lit(".csv")).alias("file_path"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("symbol"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("quote_qty"),
        (F.col("l_linenumber") % 2 == 0).alias("is_buyer_maker"),
        F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("date"),
    )
