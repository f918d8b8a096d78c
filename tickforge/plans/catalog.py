"""Registered queries and their oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built with the
library's operators over the driver's tables (through the fixed trade views
of ``tickforge.sources.views``).  ``ORACLE`` holds, per key, independent SQL
that DuckDB runs on the same tables.  Sums of floating values depend on
addition order, so both sides round those columns to 4 decimals; selected
values (open/high/low/close) are compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bars as B
from ..schema import BAR_COLUMNS, RAW_TRADE_COLUMNS
from ..sources import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SUM_COLUMNS = ["volume", "vwap", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_sums(df: DataFrame, cols=SUM_COLUMNS, digits: int = 4) -> DataFrame:
    """Check view: sums rounded, DATE and TIMESTAMP shown as TIMESTAMP_NTZ.

    Dates are compared as midnight timestamps so that both engines hand the
    same value type to any client (DuckDB turns DATE into datetime64 in pandas).
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols:
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def check_view(df: DataFrame) -> DataFrame:
    return round_sums(df, [])


# ---------------------------------------------------------------- SQL pieces

EVENTS_TRADES_SQL = """
  SELECT CASE WHEN event_type = 'purchase' THEN 'PURCHASEUSD_PERP'
              ELSE upper(event_type) || 'USDT' END AS symbol,
         event_id AS id,
         value AS price,
         CAST(1 + user_id % 10 AS DOUBLE) AS qty,
         value * CAST(1 + user_id % 10 AS DOUBLE) AS quote_qty,
         event_id % 2 = 0 AS is_buyer_maker,
         ts,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date
  FROM events"""

def _bad(rule, column: str = "event_id") -> str:
    return f"{column} % {rule[0]} = {rule[1]}"


# The same events with rows that lack flag, time or quote quantity (see sources.views).
GAPS_TRADES_SQL = f"""
  SELECT symbol, id, price, qty,
         CASE WHEN {_bad(V.NO_QUOTE, "id")} THEN 0.0 ELSE quote_qty END AS quote_qty,
         CASE WHEN NOT {_bad(V.NO_FLAG, "id")} THEN is_buyer_maker END AS is_buyer_maker,
         CASE WHEN NOT {_bad(V.NO_TIME, "id")} THEN ts END AS ts, date
  FROM ({EVENTS_TRADES_SQL}) e"""

UNCLEAN_TRADES_SQL = f"""
  SELECT * REPLACE (CASE WHEN {_bad(V.NULL_PRICE, "id")} THEN NULL WHEN {_bad(V.NAN_PRICE, "id")} THEN 'NaN'::DOUBLE
                         WHEN {_bad(V.ZERO_PRICE, "id")} THEN 0.0 ELSE price END AS price)
  FROM ({GAPS_TRADES_SQL}) g"""

LINEITEM_TRADES_SQL = """
  SELECT l_returnflag || l_linestatus AS symbol,
         l_orderkey * 10 + l_linenumber AS id,
         l_extendedprice / l_quantity AS price,
         l_quantity AS qty,
         l_extendedprice AS quote_qty,
         l_linenumber % 2 = 0 AS is_buyer_maker,
         l_shipdate AS ts,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS date
  FROM lineitem"""


def r4(expr: str, digits: int = 4) -> str:
    """Round the way Spark rounds a double: HALF_UP on its shortest decimal
    text (DuckDB's own round works on the binary value)."""
    return (
        f"CASE WHEN isnan({expr}) OR isinf({expr}) THEN {expr} ELSE "
        f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE) END"
    )


def bars_sql(trades_sql: str, step_us: int) -> str:
    """Unfilled bars, internal form keyed by bar_us (CTE body)."""
    return f"""
  SELECT symbol,
         epoch_us(ts) - epoch_us(ts) % {step_us} AS bar_us,
         first(price ORDER BY ts, id, price) AS open,
         max(price) AS high,
         min(price) AS low,
         last(price ORDER BY ts, id, price) AS close,
         sum(qty) AS volume,
         sum(quote_qty) AS quote_volume,
         sum(CASE WHEN NOT is_buyer_maker THEN qty ELSE 0.0 END) AS taker_buy_volume,
         sum(CASE WHEN NOT is_buyer_maker THEN quote_qty ELSE 0.0 END) AS taker_buy_quote_volume,
         count(*) AS "count",
         CASE WHEN sum(quote_qty) > 0 THEN sum(price * quote_qty) / sum(quote_qty) END AS vwap
  FROM ({trades_sql}) t
  WHERE ts IS NOT NULL
  GROUP BY 1, 2"""


def unfilled_select(step_us: int, src: str = "b") -> str:
    return f"""
  SELECT symbol, make_timestamp(bar_us) AS open_time, make_timestamp(bar_us + {step_us} - 1) AS close_time,
         open, high, low, close, {r4("volume")} AS volume, {r4("vwap")} AS vwap,
         {r4("quote_volume")} AS quote_volume, {r4("taker_buy_volume")} AS taker_buy_volume,
         {r4("taker_buy_quote_volume")} AS taker_buy_quote_volume, "count"
  FROM {src}"""


def filled_sql(trades_sql: str, step_us: int, rounded: bool = True, seed_sql: str | None = None, full_range: bool = False) -> str:
    """Reference-style fill: grid per (symbol, day) LEFT JOIN bars, carry last valid close per symbol.

    ``seed_sql`` (symbol, seed) supplies a close for slots before a symbol's first trade."""
    rr = r4 if rounded else (lambda e: e)
    days = "SELECT DISTINCT symbol, bar_us - bar_us % 86400000000 AS day_us FROM b"
    if full_range:
        days = f"SELECT symbol, unnest(range(min(day_us), max(day_us) + 1, 86400000000)) AS day_us FROM ({days}) d GROUP BY symbol"
    carried = "last_close" if seed_sql is None else "coalesce(last_close, (SELECT seed FROM s WHERE s.symbol = f.symbol))"
    seed_cte = "" if seed_sql is None else f"s AS ({seed_sql}),"
    body = f"""
WITH b AS ({bars_sql(trades_sql, step_us)}),
days AS ({days}),
grid AS (SELECT symbol, unnest(range(day_us, day_us + 86400000000, {step_us})) AS slot_us FROM days),
j AS (SELECT g.symbol, g.slot_us, b.open, b.high, b.low, b.close, b.volume, b.quote_volume,
             b.taker_buy_volume, b.taker_buy_quote_volume, b."count", b.vwap
      FROM grid g LEFT JOIN b ON g.symbol = b.symbol AND g.slot_us = b.bar_us),
f AS (SELECT *, last_value(CASE WHEN close IS NOT NULL AND NOT isnan(close) THEN close END IGNORE NULLS)
                OVER (PARTITION BY symbol ORDER BY slot_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_close
      FROM j)
SELECT symbol, make_timestamp(slot_us) AS open_time, make_timestamp(slot_us + {step_us} - 1) AS close_time,
       coalesce(open, last_close) AS open, coalesce(high, last_close) AS high,
       coalesce(low, last_close) AS low, coalesce(close, last_close) AS close,
       {rr("coalesce(volume, 0.0)")} AS volume, {rr("coalesce(vwap, 0.0)")} AS vwap,
       {rr("coalesce(quote_volume, 0.0)")} AS quote_volume,
       {rr("coalesce(taker_buy_volume, 0.0)")} AS taker_buy_volume,
       {rr("coalesce(taker_buy_quote_volume, 0.0)")} AS taker_buy_quote_volume,
       coalesce("count", 0) AS "count"
FROM f"""
    if seed_sql is not None:
        body = body.replace("WITH b AS (", f"WITH {seed_cte} b AS (", 1)
        body = body.replace("coalesce(open, last_close)", f"coalesce(open, {carried})")
        body = body.replace("coalesce(high, last_close)", f"coalesce(high, {carried})")
        body = body.replace("coalesce(low, last_close)", f"coalesce(low, {carried})")
        body = body.replace("coalesce(close, last_close)", f"coalesce(close, {carried})")
    return body


def _unfilled(trades_sql: str, seconds: int) -> str:
    step = seconds * 1_000_000
    return f"WITH b AS ({bars_sql(trades_sql, step)}){unfilled_select(step)}"


# ---------------------------------------------------------------- bars


@register("bars_1h", _unfilled(EVENTS_TRADES_SQL, 3600))
def q_bars_1h(spark, sf_dir):
    return round_sums(B.aggregate_bars(V.events_trades(spark, sf_dir), "1h", unique_ids=True))


@register("bars_1d", _unfilled(EVENTS_TRADES_SQL, 86400))
def q_bars_1d(spark, sf_dir):
    return round_sums(B.aggregate_bars(V.events_trades(spark, sf_dir), "24h", unique_ids=True))


@register("bars_90s", _unfilled(EVENTS_TRADES_SQL, 90))
def q_bars_90s(spark, sf_dir):
    return round_sums(B.aggregate_bars(V.events_trades(spark, sf_dir), "1m30s", unique_ids=True))


@register("bars_ties_1d", _unfilled(LINEITEM_TRADES_SQL, 86400))
def q_bars_ties_1d(spark, sf_dir):
    # lineitem ids repeat within a day: exact (ts, id, price) order, struct form.
    # "25h" exercises the rule that anything above a day is one day.
    return round_sums(B.aggregate_bars(V.lineitem_trades(spark, sf_dir), "25h"))


@register("bars_filled_1h", filled_sql(EVENTS_TRADES_SQL, 3600 * 1_000_000))
def q_bars_filled_1h(spark, sf_dir):
    return round_sums(B.fill_bars(V.events_trades(spark, sf_dir), "1h", unique_ids=True))


@register("bars_filled_5m", filled_sql(EVENTS_TRADES_SQL, 300 * 1_000_000))
def q_bars_filled_5m(spark, sf_dir):
    return round_sums(B.fill_bars(V.events_trades(spark, sf_dir), "5m", unique_ids=True))


@register("bars_filled_ties_6h", filled_sql(LINEITEM_TRADES_SQL, 6 * 3600 * 1_000_000))
def q_bars_filled_ties_6h(spark, sf_dir):
    return round_sums(B.fill_bars(V.lineitem_trades(spark, sf_dir), "6h"))


@register("bars_gaps_90s", _unfilled(GAPS_TRADES_SQL, 90))
def q_bars_gaps_90s(spark, sf_dir):
    """Trades without flag (not taker), without time (left out) and with no quote quantity (vwap null)."""
    return round_sums(B.aggregate_bars(V.events_trades(spark, sf_dir, gaps=True), "90s"))


def flagship(spark, sf_dir):
    """Gap-filled 1-hour bars with ``bucket``, the bars job's output."""
    return B.compute_bars(V.events_trades(spark, sf_dir), "1h", fill=True, unique_ids=True)


# ---------------------------------------------------------------- preparation

def raw_sql(trades: str) -> str:
    return f"""
  SELECT id, price, qty, quote_qty, epoch_us(ts) // 1000 AS time, is_buyer_maker,
         'file:///raw/' || symbol || '-trades-' || strftime(date, '%Y-%m-%d') || '.csv' AS file_path
  FROM ({trades}) e"""


def prepared_sql(raw: str) -> str:
    return f"""
  WITH r AS ({raw}),
  n AS (SELECT *, regexp_split_to_array(file_path, '[\\\\/]+')[-1] AS fname FROM r),
  m AS (SELECT id, price, qty, quote_qty, time, is_buyer_maker,
               CASE WHEN position('-trades-' IN fname) > 0 THEN fname[1:position('-trades-' IN fname) - 1] ELSE fname END AS symbol,
               try_strptime(regexp_extract(fname, '-trades-([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '%Y-%m-%d')::DATE::TIMESTAMP AS date,
               make_timestamp(time * 1000) AS ts
        FROM n),
  k AS (SELECT *, CASE WHEN contains(upper(symbol), '_PERP') THEN 'cm' ELSE 'um' END AS market FROM m),
  a AS (SELECT id, price, qty,
               CASE WHEN market = 'cm' AND quote_qty <> 0 THEN qty * 100 / quote_qty ELSE quote_qty END AS quote_qty,
               time, is_buyer_maker, symbol, date, ts, market
        FROM k)
  SELECT * FROM a
  WHERE price > 0 AND NOT isnan(price) AND NOT isnan(qty) AND NOT isnan(quote_qty)
    AND id IS NOT NULL AND price IS NOT NULL AND qty IS NOT NULL AND quote_qty IS NOT NULL
    AND time IS NOT NULL AND is_buyer_maker IS NOT NULL AND symbol IS NOT NULL
    AND date IS NOT NULL AND ts IS NOT NULL AND market IS NOT NULL"""


RAW_EVENTS_SQL = raw_sql(EVENTS_TRADES_SQL)
PREPARED_SQL = prepared_sql(RAW_EVENTS_SQL)
PREPARED_UNCLEAN_SQL = prepared_sql(raw_sql(UNCLEAN_TRADES_SQL))


@register(
    "file_metadata",
    f"""WITH r AS ({RAW_EVENTS_SQL}),
    n AS (SELECT id, file_path, regexp_split_to_array(file_path, '[\\\\/]+')[-1] AS fname FROM r)
    SELECT id, file_path,
           CASE WHEN position('-trades-' IN fname) > 0 THEN fname[1:position('-trades-' IN fname) - 1] ELSE fname END AS symbol,
           try_strptime(regexp_extract(fname, '-trades-([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '%Y-%m-%d')::DATE::TIMESTAMP AS date
    FROM n""",
)
def q_file_metadata(spark, sf_dir):
    from ..operators.prepare import parse_file_metadata

    return check_view(parse_file_metadata(V.events_raw_trades(spark, sf_dir).select("id", "file_path")))


@register("ts_from_millis", f"SELECT id, time, make_timestamp(time * 1000) AS ts FROM ({RAW_EVENTS_SQL}) r")
def q_ts_from_millis(spark, sf_dir):
    from ..operators.prepare import with_event_time

    return check_view(with_event_time(V.events_raw_trades(spark, sf_dir).select("id", "time")))


@register(
    "market_classify",
    f"""SELECT symbol, CASE WHEN contains(upper(symbol), '_PERP') THEN 'cm' ELSE 'um' END AS market, count(*) AS trades
    FROM ({EVENTS_TRADES_SQL}) t GROUP BY symbol""",
)
def q_market_classify(spark, sf_dir):
    from ..operators.prepare import classify_market

    return classify_market(V.events_trades(spark, sf_dir)).groupBy("symbol", "market").agg(F.count(F.lit(1)).alias("trades"))


@register(
    "adjust_quote_qty",
    f"""SELECT id, market, {r4("CASE WHEN market = 'cm' AND quote_qty <> 0 THEN qty * 100 / quote_qty ELSE quote_qty END")} AS quote_qty
    FROM (SELECT *, CASE WHEN contains(upper(symbol), '_PERP') THEN 'cm' ELSE 'um' END AS market FROM ({EVENTS_TRADES_SQL}) t) x""",
)
def q_adjust_quote_qty(spark, sf_dir):
    from ..operators.prepare import adjust_quote_qty, classify_market

    df = adjust_quote_qty(classify_market(V.events_trades(spark, sf_dir)), 100)
    return round_sums(df.select("id", "market", "quote_qty"), ["quote_qty"])


@register("valid_trades", f"SELECT * FROM ({PREPARED_UNCLEAN_SQL}) p")
def q_valid_trades(spark, sf_dir):
    """The row check on fully derived rows of which some are not valid."""
    from ..operators import prepare as P
    from ..schema import PREPARED_TRADE_COLUMNS

    raw = P.parse_file_metadata(V.raw_of(V.events_unclean(spark, sf_dir)), "file_path")
    derived = P.adjust_quote_qty(P.classify_market(P.with_event_time(raw)))
    return check_view(P.valid_trades(derived.select(*PREPARED_TRADE_COLUMNS)))


@register("prepare_trades", f"SELECT * FROM ({PREPARED_UNCLEAN_SQL}) p")
def q_prepare_trades(spark, sf_dir):
    """The same rows by the whole preparation, which checks raw columns first."""
    from ..operators.prepare import prepare_trades

    return check_view(prepare_trades(V.raw_of(V.events_unclean(spark, sf_dir))))


@register(
    "filter_symbols",
    f"""SELECT symbol, date, count(*) AS trades FROM ({EVENTS_TRADES_SQL}) t
    WHERE symbol IN ('CLICKUSDT', 'PURCHASEUSD_PERP') GROUP BY symbol, date""",
)
def q_filter_symbols(spark, sf_dir):
    from ..operators.filters import filter_symbols

    df = filter_symbols(V.events_trades(spark, sf_dir), ["CLICKUSDT", "PURCHASEUSD_PERP"])
    return check_view(df.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("trades")))


@register(
    "filter_date_range",
    f"""SELECT id, symbol, date FROM ({EVENTS_TRADES_SQL}) t
    WHERE date >= TIMESTAMP '2024-01-05' AND date <= TIMESTAMP '2024-01-20'""",
)
def q_filter_date_range(spark, sf_dir):
    from ..operators.filters import filter_date_range

    return check_view(filter_date_range(V.events_trades(spark, sf_dir), "2024-01-05", "2024-01-20").select("id", "symbol", "date"))


@register(
    "raw_trades_scan",
    f"""SELECT id, price, qty, quote_qty, time, is_buyer_maker,
           regexp_replace(regexp_split_to_array(file_path, '[\\\\/]+')[-1], '\\.csv$', '') AS stem
    FROM ({RAW_EVENTS_SQL}) r""",
)
def q_raw_trades_scan(spark, sf_dir):
    """Lands the events trades as raw CSV files, then scans them back."""
    from ..functions.names import file_name
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files
    from ..sources.trades import read_trades

    root = shared_dir(spark, "raw-trades")
    land(write_trade_files(V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp"))), root))
    df = read_trades(spark, root)
    # Task-numbered part suffix is a writer detail; the stem before it is the published name.
    stem = F.regexp_replace(file_name(F.col("file_path")), r"-p[0-9]+\.csv$", "")
    return df.select(*[c for c in df.columns if c != "file_path"], stem.alias("stem"))


@register("trades_prepared", f"SELECT * FROM ({PREPARED_UNCLEAN_SQL}) p")
def q_trades_prepared(spark, sf_dir):
    """Whole trades job on landed files: scan -> prepare -> partitioned table -> load."""
    from ..plans.jobs import preprocess
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files

    raw_root = shared_dir(spark, "raw-trades")
    land(write_trade_files(V.events_unclean(spark, sf_dir), raw_root))
    table_root = shared_dir(spark, "trades")
    preprocess(spark, raw_root, table_root)
    back = spark.read.parquet(table_root)
    from ..schema import PREPARED_TRADE_COLUMNS

    return check_view(back.select(*PREPARED_TRADE_COLUMNS))


# ---------------------------------------------------------------- durations (T1) and more bars

# Duration texts derived from each event row: valid, above a day, not dividing
# the day, blanks inside, days, empty - one SQL expression both engines run.
DURATION_TEXT_SQL = """CASE event_id % 8
    WHEN 0 THEN CAST(user_id % 30 + 1 AS STRING) || 'm'
    WHEN 1 THEN CAST(user_id % 5 AS STRING) || 'h' || CAST(user_id % 60 AS STRING) || 'm'
    WHEN 2 THEN CAST(user_id % 100 AS STRING) || 's'
    WHEN 3 THEN ' ' || upper(CAST(user_id % 48 AS STRING) || 'h') || ' '
    WHEN 4 THEN CAST(user_id % 3 AS STRING) || 'h ' || CAST(user_id % 7 AS STRING) || 'm'
    WHEN 5 THEN CAST(user_id % 4 AS STRING) || 'd'
    WHEN 6 THEN CAST(user_id % 2 AS STRING) || 'h' || CAST(user_id % 2 AS STRING) || 'm' || CAST(user_id % 90 AS STRING) || 's'
    ELSE '' END"""

_PAT = r"^(?:(\d+)h)?(?:(\d+)m)?(?:(\d+)s)?$"


def _sql_part(i: int) -> str:
    return f"coalesce(CAST(nullif(regexp_extract(norm, '{_PAT}', {i}), '') AS BIGINT), 0)"


def _sql_word(n: str, unit: str) -> str:
    return f"CASE WHEN ({n}) > 0 THEN CAST({n} AS STRING) || ' {unit}' || CASE WHEN ({n}) > 1 THEN 's' ELSE '' END END"


TIMEFRAME_SQL = f"""
WITH s AS (SELECT event_id AS id, {DURATION_TEXT_SQL} AS text FROM events),
n AS (SELECT id, text, lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS norm FROM s),
p AS (SELECT id, text, regexp_full_match(norm, '{_PAT}') AS ok,
             {_sql_part(1)} * 3600 + {_sql_part(2)} * 60 + {_sql_part(3)} AS total FROM n),
e AS (SELECT *, CASE WHEN text IS NULL THEN 'duration must be text such as ''60s'' or ''1m30s'''
                     WHEN NOT ok THEN 'invalid duration format; use e.g. ''30s'', ''5m'', ''2h'' or ''1m30s'''
                     WHEN total < 1 THEN 'duration must be at least 1 second'
                     WHEN total > 86400 THEN NULL
                     WHEN 86400 % total <> 0 THEN 'duration must divide 24 hours (86400 seconds)' END AS error
      FROM p)
SELECT id, text,
       CASE WHEN error IS NULL THEN CAST(least(total, 86400) AS DOUBLE) END AS seconds,
       CASE WHEN error IS NULL THEN
         CASE WHEN total > 86400 THEN '1 day'
              WHEN total >= 3600 THEN concat_ws(' ', {_sql_word("total // 3600", "hour")}, {_sql_word("(total % 3600) // 60", "minute")}, {_sql_word("total % 60", "second")})
              WHEN total >= 60 THEN concat_ws(' ', {_sql_word("total // 60", "minute")}, {_sql_word("total % 60", "second")})
              ELSE {_sql_word("total", "second")} END
       END AS label,
       error
FROM e"""


@register("timeframe_parse", TIMEFRAME_SQL)
def q_timeframe_parse(spark, sf_dir):
    from ..functions.timeframe import parse_timeframes

    ev = V.table(spark, sf_dir, "events")
    specs = ev.select(F.col("event_id").alias("id"), F.expr(DURATION_TEXT_SQL).alias("text"))
    parsed = parse_timeframes(specs, "text")
    # seconds is null on rejected rows: shown as DOUBLE so any client keeps nulls apart from numbers.
    return parsed.select("id", "text", F.col("tf.seconds").cast("double").alias("seconds"), "tf.label", "tf.error")


MULTI_DURATIONS = [("1m30s", 90, "1 minute 30 seconds"), ("5m", 300, "5 minutes"), ("1h", 3600, "1 hour")]

MULTI_SQL = " UNION ALL ".join(
    f"""SELECT '{label}' AS timeframe, CAST({sec} AS INTEGER) AS seconds, x.*,
           CAST(CAST(open_time AS DATE) AS TIMESTAMP) AS bucket
    FROM ({_unfilled(EVENTS_TRADES_SQL, sec)}) x"""
    for _, sec, label in MULTI_DURATIONS
)


@register("bars_multi", MULTI_SQL)
def q_bars_multi(spark, sf_dir):
    """Several durations in one job (T1 labels, one shuffle)."""
    out = B.bars_for_durations(V.events_trades(spark, sf_dir), [t for t, _, _ in MULTI_DURATIONS], unique_ids=True)
    return round_sums(out)


@register(
    "bar_grid_1h",
    f"""WITH d AS (SELECT DISTINCT symbol, epoch_us(ts) - epoch_us(ts) % 86400000000 AS day_us
                FROM ({EVENTS_TRADES_SQL}) t WHERE ts IS NOT NULL)
    SELECT symbol, make_timestamp(unnest(range(day_us, day_us + 86400000000, 3600000000))) AS bar_time FROM d""",
)
def q_bar_grid_1h(spark, sf_dir):
    return B.bar_grid(V.events_trades(spark, sf_dir), "1h")


_FILLED_1M = filled_sql(EVENTS_TRADES_SQL, 60 * 1_000_000)


@register(
    "forward_fill_close",
    f"SELECT symbol, open_time AS bar_time, close AS last_close FROM ({_FILLED_1M}) x",
)
def q_forward_fill_close(spark, sf_dir):
    return B.forward_fill_close(V.events_trades(spark, sf_dir), "1m", unique_ids=True)


@register(
    "vwap_1m",
    f"""WITH b AS ({bars_sql(EVENTS_TRADES_SQL, 60_000_000)})
    SELECT symbol, make_timestamp(bar_us) AS open_time, {r4("vwap")} AS vwap, {r4("quote_volume")} AS quote_volume FROM b""",
)
def q_vwap_1m(spark, sf_dir):
    bars = B.aggregate_bars(V.events_trades(spark, sf_dir), "1m", unique_ids=True)
    return round_sums(bars.select("symbol", "open_time", "vwap", "quote_volume"))


def _r5(c: str) -> str:
    return r4(c, 5)


CHECK_PROJECTION_SQL = f"""
SELECT symbol, open_time,
       {_r5("open")} AS open, {_r5("high")} AS high, {_r5("low")} AS low, {_r5("close")} AS close,
       {_r5("volume")} AS volume, {_r5("quote_volume")} AS quote_volume, CAST("count" AS BIGINT) AS "count",
       {_r5("taker_buy_volume")} AS taker_buy_volume, {_r5("taker_buy_quote_volume")} AS taker_buy_quote_volume,
       CAST(row_number() OVER (PARTITION BY symbol ORDER BY open_time) - 1 AS BIGINT) AS idx
FROM ({filled_sql(EVENTS_TRADES_SQL, 3600 * 1_000_000, rounded=False)}) f"""


@register("check_projection", CHECK_PROJECTION_SQL)
def q_check_projection(spark, sf_dir):
    from ..operators.quality import comparison_projection

    return comparison_projection(_generated_bars(spark, sf_dir), keep=["symbol", "open_time"], index=True)


@register(
    "bar_index",
    f"""SELECT symbol, open_time, CAST(row_number() OVER (PARTITION BY symbol ORDER BY open_time) - 1 AS BIGINT) AS idx
    FROM ({_FILLED_1M}) x""",
)
def q_bar_index(spark, sf_dir):
    from ..operators.quality import with_bar_index

    bars = _stored(spark, B.compute_bars(V.events_trades(spark, sf_dir), "1m", fill=True, unique_ids=True), "1m")
    return with_bar_index(bars.select("symbol", "open_time"))


# ---------------------------------------------------------------- bar comparison

# Reference bars for the checks: unfilled 1-hour bars of the same events with
# another taker flag (user_id even), so taker columns differ and the filled
# slots are missing on the reference side.
EVENTS_REF_TRADES_SQL = EVENTS_TRADES_SQL.replace("event_id % 2 = 0 AS is_buyer_maker", "user_id % 2 = 0 AS is_buyer_maker")


def _stored(spark, bars, timeframe) -> DataFrame:
    """Bars written as a bars table and read back, as the checks find them."""
    from ..session import shared_dir
    from ..sinks.tables import write_bars
    from ..sources.trades import load_bars

    root = shared_dir(spark, "bars")
    write_bars(bars, root, timeframe)
    return load_bars(spark, root, timeframe)


def _reference_bars(spark, sf_dir):
    return B.aggregate_bars(V.events_trades(spark, sf_dir, maker_from="user_id"), "1h", unique_ids=True)


def _generated_bars(spark, sf_dir):
    return _stored(spark, B.compute_bars(V.events_trades(spark, sf_dir), "1h", fill=True, unique_ids=True), "1h")


_GEN_SQL = filled_sql(EVENTS_TRADES_SQL, 3600 * 1_000_000, rounded=False)
_REF_SQL = f"""WITH b AS ({bars_sql(EVENTS_REF_TRADES_SQL, 3600 * 1_000_000)})
  SELECT symbol, make_timestamp(bar_us) AS open_time, open, high, low, close, volume, vwap, quote_volume,
         taker_buy_volume, taker_buy_quote_volume, "count" FROM b"""
_CMP_COLS = ["open", "high", "low", "close", "volume", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume"]


def _proj_sql(src: str, suffix: str) -> str:
    cols = ", ".join(
        (f'CAST("count" AS BIGINT) AS count_{suffix}' if c == "count" else f"{_r5(c)} AS {c}_{suffix}") for c in _CMP_COLS
    )
    return f"SELECT symbol, open_time, {cols}, TRUE AS in_{suffix} FROM ({src}) s"


_JOINED_SQL = f"""
  SELECT coalesce(g.symbol, r.symbol) AS symbol, coalesce(g.open_time, r.open_time) AS open_time, g.*, r.*
  FROM ({_proj_sql(_GEN_SQL, 'gen')}) g FULL OUTER JOIN ({_proj_sql(_REF_SQL, 'ref')}) r
    ON g.symbol = r.symbol AND g.open_time = r.open_time"""

_LONG_SQL = " UNION ALL ".join(
    f"""SELECT symbol, open_time, '{c}' AS "column", CAST({c}_gen AS DOUBLE) AS generated, CAST({c}_ref AS DOUBLE) AS reference
    FROM j WHERE in_gen AND in_ref"""
    for c in _CMP_COLS
)

_DIFFS_SQL = f"""WITH j AS (SELECT * EXCLUDE (symbol, open_time), symbol, open_time FROM ({_JOINED_SQL}) x),
  l AS ({_LONG_SQL})
  SELECT * FROM l WHERE generated IS NOT NULL AND reference IS NOT NULL AND abs(generated - reference) > 1e-5"""


@register(
    "check_full_outer",
    f"""SELECT symbol, open_time,
           {", ".join((f"CAST({c}_gen AS DOUBLE) AS {c}_gen" if c == "count" else f"{c}_gen") for c in _CMP_COLS)},
           {", ".join((f"CAST({c}_ref AS DOUBLE) AS {c}_ref" if c == "count" else f"{c}_ref") for c in _CMP_COLS)}
    FROM (SELECT * EXCLUDE (symbol, open_time), symbol, open_time FROM ({_JOINED_SQL}) x) y""",
)
def q_check_full_outer(spark, sf_dir):
    from ..operators.quality import full_outer

    out = full_outer(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir))
    # Outer-join counts are nullable: DOUBLE in the check view (see timeframe_parse).
    return out.withColumn("count_gen", F.col("count_gen").cast("double")).withColumn("count_ref", F.col("count_ref").cast("double"))


@register(
    "check_row_counts",
    f"""WITH g AS (SELECT symbol, count(*) AS n FROM ({_GEN_SQL}) a GROUP BY symbol),
         r AS (SELECT symbol, count(*) AS n FROM ({_REF_SQL}) b GROUP BY symbol)
    SELECT coalesce(g.symbol, r.symbol) AS symbol, coalesce(g.n, 0) AS rows_generated, coalesce(r.n, 0) AS rows_reference,
           coalesce(g.n, 0) = coalesce(r.n, 0) AS same_count
    FROM g FULL OUTER JOIN r ON g.symbol = r.symbol""",
)
def q_check_row_counts(spark, sf_dir):
    from ..operators.quality import row_counts

    return row_counts(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir))


@register(
    "check_missing",
    f"""WITH j AS (SELECT * EXCLUDE (symbol, open_time), symbol, open_time FROM ({_JOINED_SQL}) x)
    SELECT 'generated' AS missing_in, symbol, open_time, open_ref AS open, close_ref AS close, volume_ref AS volume FROM j WHERE in_gen IS NULL
    UNION ALL
    SELECT 'reference' AS missing_in, symbol, open_time, open_gen AS open, close_gen AS close, volume_gen AS volume FROM j WHERE in_ref IS NULL""",
)
def q_check_missing(spark, sf_dir):
    from ..operators.quality import missing_rows

    return missing_rows(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir))


@register("check_diffs", _DIFFS_SQL)
def q_check_diffs(spark, sf_dir):
    from ..operators.quality import value_diffs

    return value_diffs(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir))


@register(
    "check_top10",
    f"""WITH d AS ({_DIFFS_SQL}),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY symbol, "column" ORDER BY open_time) AS BIGINT) AS rank FROM d)
    SELECT * FROM k WHERE rank <= 10""",
)
def q_check_top10(spark, sf_dir):
    from ..operators.quality import first_diffs, value_diffs

    return first_diffs(value_diffs(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir)))


def _pairs_sql(gen: str, ref: str) -> str:
    """Aligned rows; the n-th copy of a bar on one side meets the n-th on the other."""
    order = ", ".join(f"{c} NULLS FIRST" for c in (f"{c}_@" for c in _CMP_COLS))

    def side(src, suffix):
        return f"""SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY {order.replace("@", suffix)}) AS copy
        FROM ({_proj_sql(src, suffix)}) p"""

    return f"""SELECT coalesce(g.symbol, r.symbol) AS symbol, coalesce(g.open_time, r.open_time) AS open_time,
        g.* EXCLUDE (symbol, open_time, copy), r.* EXCLUDE (symbol, open_time, copy)
      FROM ({side(gen, "gen")}) g FULL OUTER JOIN ({side(ref, "ref")}) r
        ON g.symbol = r.symbol AND g.open_time = r.open_time AND g.copy = r.copy"""


def verdict_sql(gen: str, ref: str, same_schema: str = "TRUE") -> str:
    differ = " + ".join(f"CASE WHEN abs(CAST({c}_gen AS DOUBLE) - CAST({c}_ref AS DOUBLE)) > 1e-5 THEN 1 ELSE 0 END" for c in _CMP_COLS)
    one_null = " + ".join(f"CASE WHEN ({c}_gen IS NULL) <> ({c}_ref IS NULL) THEN 1 ELSE 0 END" for c in _CMP_COLS)
    same = " AND ".join(f"{c}_gen IS NOT DISTINCT FROM {c}_ref" for c in _CMP_COLS)
    return f"""WITH j AS ({_pairs_sql(gen, ref)}),
    v AS (SELECT symbol, count(in_gen) AS rows_generated, count(in_ref) AS rows_reference,
                 count(*) - count(in_gen) AS missing_in_generated, count(*) - count(in_ref) AS missing_in_reference,
                 CAST(sum(CASE WHEN in_gen AND in_ref THEN {differ} ELSE 0 END) AS BIGINT) AS differing_cells,
                 CAST(sum(CASE WHEN in_gen AND in_ref THEN {one_null} ELSE 0 END) AS BIGINT) AS null_cells,
                 {same_schema} AS same_schema,
                 {same_schema} AND bool_and(in_gen IS NOT NULL AND in_ref IS NOT NULL AND {same}) AS exact
          FROM j GROUP BY symbol)
    SELECT *, same_schema AND missing_in_generated + missing_in_reference + differing_cells + null_cells = 0 AS equal,
           CASE WHEN same_schema AND missing_in_generated + missing_in_reference + differing_cells + null_cells = 0 THEN 0 ELSE 1 END AS status
    FROM v"""


@register("check_verdict", verdict_sql(_GEN_SQL, _REF_SQL))
def q_check_verdict(spark, sf_dir):
    from ..operators.quality import verdict

    return verdict(_generated_bars(spark, sf_dir), _reference_bars(spark, sf_dir))


# A reference with one fault per symbol: a null cell (CLICK), a value (ERROR), a bar twice
# (PURCHASE), a bar missing on each side (SIGNUP), none (VIEW).
_AT = "CAST(open_time AS DATE) = DATE '2024-01-10' AND hour(open_time) ="
_MIXED_GEN_SQL = f"SELECT * FROM ({_GEN_SQL}) g WHERE NOT (symbol = 'SIGNUPUSDT' AND {_AT} 8)"
_MIXED_REF_SQL = f"""
  SELECT * REPLACE (CASE WHEN symbol = 'CLICKUSDT' AND {_AT} 3 THEN NULL
                         WHEN symbol = 'ERRORUSDT' AND {_AT} 4 THEN close + 1 ELSE close END AS close)
  FROM ({_GEN_SQL}) g WHERE NOT (symbol = 'SIGNUPUSDT' AND {_AT} 7)
  UNION ALL SELECT * FROM ({_GEN_SQL}) g WHERE symbol = 'PURCHASEUSD_PERP' AND {_AT} 5"""


def _mixed_bars(spark, sf_dir):
    """(generated, reference) as ``_MIXED_GEN_SQL`` and ``_MIXED_REF_SQL``, from one stored table."""
    bars = _generated_bars(spark, sf_dir)
    at = lambda symbol, hour: (F.col("symbol") == symbol) & (F.to_date("open_time") == "2024-01-10") & (F.hour("open_time") == hour)
    close = F.when(at("CLICKUSDT", 3), None).when(at("ERRORUSDT", 4), F.col("close") + 1).otherwise(F.col("close"))
    ref = bars.where(~at("SIGNUPUSDT", 7)).withColumn("close", close).unionByName(bars.where(at("PURCHASEUSD_PERP", 5)))
    return bars.where(~at("SIGNUPUSDT", 8)), ref


@register("check_verdict_mixed", verdict_sql(_MIXED_GEN_SQL, _MIXED_REF_SQL))
def q_check_verdict_mixed(spark, sf_dir):
    """One symbol passes; the others fail by null, value, duplicate, and missing bars on both sides."""
    from ..operators.quality import verdict

    return verdict(*_mixed_bars(spark, sf_dir))


@register("check_verdict_schema", verdict_sql(_GEN_SQL, f"SELECT * REPLACE (NULL::DOUBLE AS taker_buy_volume) FROM ({_GEN_SQL}) g", "FALSE"))
def q_check_verdict_schema(spark, sf_dir):
    """A reference that lacks a compared column fails, whatever the values."""
    from ..operators.quality import verdict

    bars = _generated_bars(spark, sf_dir)
    return verdict(bars, bars.drop("taker_buy_volume"))


@register(
    "check_missing_mixed",
    f"""WITH j AS ({_pairs_sql(_MIXED_GEN_SQL, _MIXED_REF_SQL)})
    SELECT CASE WHEN in_gen IS NULL THEN 'generated' ELSE 'reference' END AS missing_in, symbol, open_time,
           coalesce(open_gen, open_ref) AS open, coalesce(close_gen, close_ref) AS close, coalesce(volume_gen, volume_ref) AS volume
    FROM j WHERE in_gen IS NULL OR in_ref IS NULL""",
)
def q_check_missing_mixed(spark, sf_dir):
    from ..operators.quality import missing_rows

    return missing_rows(*_mixed_bars(spark, sf_dir))


# ---------------------------------------------------------------- reports

# The events tables span these days at every scale factor (fixed in the SQL only:
# the Spark side discovers them).
EVENT_DAYS = [f"2024-01-{d:02d}" for d in range(1, 31)]

_COUNTS_SQL = f"""SELECT symbol, strftime(date, '%Y-%m-%d') AS day, count(*) AS trade_count
    FROM ({EVENTS_TRADES_SQL}) t GROUP BY 1, 2"""

_CUBE_SQL = f"""SELECT CASE WHEN grouping(symbol) = 1 THEN 'Total' ELSE symbol END AS symbol,
           CASE WHEN grouping(day) = 1 THEN 'Total' ELSE day END AS day,
           CAST(sum(trade_count) AS BIGINT) AS trade_count
    FROM ({_COUNTS_SQL}) c GROUP BY CUBE (symbol, day)"""


def _counts(spark, sf_dir):
    from ..operators.report import trade_counts

    return trade_counts(V.events_trades(spark, sf_dir))


@register(
    "trade_counts",
    f"""SELECT symbol, CAST(strptime(day, '%Y-%m-%d') AS TIMESTAMP) AS date, trade_count FROM ({_COUNTS_SQL}) c""",
)
def q_trade_counts(spark, sf_dir):
    return check_view(_counts(spark, sf_dir))


@register("trade_count_totals", _CUBE_SQL)
def q_trade_count_totals(spark, sf_dir):
    from ..operators.report import trade_count_totals

    return trade_count_totals(_counts(spark, sf_dir))


_PIVOT_COLS = ", ".join(
    f"""CAST(coalesce(max(trade_count) FILTER (WHERE day = '{d}'), 0) AS BIGINT) AS "{d}\"""" for d in EVENT_DAYS + ["Total"]
)


@register("trade_count_pivot", f"SELECT symbol, {_PIVOT_COLS} FROM ({_CUBE_SQL}) l GROUP BY symbol")
def q_trade_count_pivot(spark, sf_dir):
    from ..operators.report import trade_count_matrix

    return trade_count_matrix(_counts(spark, sf_dir))


def _list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


_REPORT_COLUMNS = ["symbol"] + EVENT_DAYS + ["Total"]
REPORT_SQL = f"""
WITH l AS ({_CUBE_SQL}),
rk AS (SELECT DISTINCT symbol FROM l),
cols AS (SELECT unnest({_list(EVENT_DAYS + ["Total"])}) AS day),
g AS (SELECT rk.symbol, cols.day FROM rk, cols),
cells AS (SELECT g.symbol, g.day, format('{{:,}}', coalesce(l.trade_count, 0)) AS text
          FROM g LEFT JOIN l ON g.symbol = l.symbol AND g.day = l.day
          UNION ALL SELECT symbol, 'symbol' AS day, symbol AS text FROM rk),
w AS (SELECT day, greatest(max(length(text)), length(day)) + 2 AS w FROM cells GROUP BY day),
pos AS (SELECT unnest({_list(_REPORT_COLUMNS)}) AS day, unnest(range(0, {len(_REPORT_COLUMNS)})) AS pos),
padded AS (SELECT cells.symbol, pos.pos, lpad(cells.text, CAST(w.w AS INTEGER), ' ') AS cell
           FROM cells JOIN w ON cells.day = w.day JOIN pos ON cells.day = pos.day),
body AS (SELECT symbol, string_agg(cell, '' ORDER BY pos) AS line FROM padded GROUP BY symbol),
hdr AS (SELECT string_agg(lpad(w.day, CAST(w.w AS INTEGER), ' '), '' ORDER BY pos.pos) AS line, sum(w.w) AS width
        FROM w JOIN pos ON w.day = pos.day)
SELECT 0 AS section, CAST(NULL AS VARCHAR) AS symbol, '  Asset Metrics - Trade Count per Symbol / Day' AS line
UNION ALL SELECT 1, NULL, repeat('-', CAST(width AS INTEGER)) FROM hdr
UNION ALL SELECT 2, NULL, line FROM hdr
UNION ALL SELECT 3, NULL, repeat('-', CAST(width AS INTEGER)) FROM hdr
UNION ALL SELECT CASE WHEN symbol = 'Total' THEN 6 ELSE 4 END, CASE WHEN symbol = 'Total' THEN NULL ELSE symbol END, line FROM body
UNION ALL SELECT 5, NULL, repeat('-', CAST(width AS INTEGER)) FROM hdr
UNION ALL SELECT 7, NULL, repeat('-', CAST(width AS INTEGER)) FROM hdr"""


@register("trade_count_report", REPORT_SQL)
def q_trade_count_report(spark, sf_dir):
    from ..operators.report import trade_count_report

    return trade_count_report(_counts(spark, sf_dir))


_CHART_SYMBOLS = ["CLICKUSDT", "PURCHASEUSD_PERP", "VIEWUSDT"]
_CHART_ARRAYS = ", ".join(
    [f"list(strftime(open_time, '%Y-%m-%d %H:%M:%S.%f') ORDER BY open_time) AS open_time"]
    + [f"list({c} ORDER BY open_time) AS {c}" for c in ["open", "high", "low", "close", "volume", "vwap"]]
)
CHART_SQL = f"""
WITH b AS ({filled_sql(EVENTS_TRADES_SQL, 3600 * 1_000_000)}),
f AS (SELECT *, CAST(open_time AS DATE) AS bucket FROM b
      WHERE symbol IN ('CLICKUSDT', 'PURCHASEUSD_PERP', 'VIEWUSDT')
        AND CAST(open_time AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-05')
SELECT symbol, CAST(bucket AS TIMESTAMP) AS bucket,
       symbol || ' OHLC - 1_hour Bars (2024-01-03 to 2024-01-05)' AS title,
       lower(symbol) || '_ohlc_2024-01-03_to_2024-01-05' AS file_stem,
       CASE WHEN position('USDT' IN symbol) > 0 THEN symbol[1:position('USDT' IN symbol) - 1] ELSE symbol END AS axis_symbol,
       {_CHART_ARRAYS}
FROM f GROUP BY symbol, bucket"""


@register("chart_series", CHART_SQL)
def q_chart_series(spark, sf_dir):
    from ..operators.report import chart_series

    bars = round_sums(B.compute_bars(V.events_trades(spark, sf_dir), "1h", fill=True, unique_ids=True))
    bars = bars.withColumn("bucket", F.to_date("bucket"))
    return check_view(chart_series(bars, _CHART_SYMBOLS, "1_hour", "2024-01-03", "2024-01-05"))


# ---------------------------------------------------------------- manifests, archives, klines, jobs

_BASES_SQL = "SELECT DISTINCT upper(event_type) || 'USD' AS symbol FROM events"
_ROOT = "https://data.example/futures"
MANIFEST_SQL = f"""
SELECT strftime(d, '%Y-%m-%d') AS date, b.symbol || 'T' AS symbol,
       '{_ROOT}/um/daily/trades/' || b.symbol || 'T/' || b.symbol || 'T-trades-' || strftime(d, '%Y-%m-%d') || '.zip' AS url,
       'um' AS market
FROM ({_BASES_SQL}) b, (SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS d) g"""


def _bases(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    return ev.select(F.concat(F.upper("event_type"), F.lit("USD")).alias("symbol")).distinct()


def _days(spark, sf_dir):
    """First and last day of the events."""
    day = F.to_date("ts")
    return V.table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first()


def _manifest(spark, sf_dir):
    from ..operators.manifest import file_manifest

    return file_manifest(_bases(spark, sf_dir), *_days(spark, sf_dir), market="um", root=_ROOT)


@register("manifest", MANIFEST_SQL)
def q_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


@register("manifest_document", f"SELECT market, date, symbol, url FROM ({MANIFEST_SQL}) m")
def q_manifest_document(spark, sf_dir):
    """Manifest written as a JSON document and read back."""
    from ..operators.manifest import manifest_document, manifest_urls
    from ..session import shared_dir
    from ..sources.files import read_manifest, write_manifest

    path = shared_dir(spark, "manifest")
    write_manifest(manifest_document(_manifest(spark, sf_dir), *_days(spark, sf_dir)), path)
    return manifest_urls(read_manifest(spark, path))


def _landed_archives(spark, sf_dir, trades=None) -> str:
    """Lands trades (the events by default) as zipped daily files; returns the folder."""
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files

    root = shared_dir(spark, "archives")
    if trades is None:
        trades = V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp")))
    land(write_trade_files(trades, root, archive=True))
    return root


def _add_broken(spark, root: str) -> str:
    """Adds to landed archives two broken copies of one of them, cut off and with changed
    bytes, and a good one with a malformed line: one field too many."""
    from ..sources.files import list_files

    def write(batches):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs as pafs

        for pdf in batches:
            for uri in pdf["path"]:
                filesystem, path = pafs.FileSystem.from_uri(uri)
                with filesystem.open_input_file(path) as f:
                    whole = f.read()
                with zipfile.ZipFile(io.BytesIO(whole)) as z:
                    at = z.infolist()[0].header_offset + 30 + len(z.infolist()[0].filename) + z.infolist()[0].compress_size // 2
                    lines = z.read(z.namelist()[0]).split(b"\n")
                extra = io.BytesIO()
                with zipfile.ZipFile(extra, "w") as z:
                    z.writestr("EXTRAUSDT-trades-2024-01-10.csv", b"\n".join([lines[0], lines[1] + b",1", b""]))
                copies = {
                    "CUTUSDT-trades-2024-01-10.zip": whole[: len(whole) // 2],
                    "CRCUSDT-trades-2024-01-10.zip": whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :],
                    "EXTRAUSDT-trades-2024-01-10.zip": extra.getvalue(),
                }
                for name, data in copies.items():
                    with filesystem.open_output_stream(f"{path.rpartition('/')[0]}/{name}") as f:
                        f.write(data)
            yield pd.DataFrame({"n": [len(pdf)]})

    one = list_files(spark, root, "VIEWUSDT-trades-2024-01-10*.zip").agg(F.min("path").alias("path")).where(F.col("path").isNotNull())
    one.mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()
    return root


_LANDED_SQL = f"SELECT DISTINCT symbol, strftime(date, '%Y-%m-%d') AS date FROM ({EVENTS_TRADES_SQL}) t"


# Every symbol trades every day in the events: some days are left out, other ones per symbol.
_SPARSE_SQL = f"""SELECT * FROM ({EVENTS_TRADES_SQL}) e
  WHERE (dayofmonth(ts) + length(symbol)) % 5 < 2 AND NOT (symbol = 'VIEWUSDT' AND dayofmonth(ts) BETWEEN 6 AND 24)"""


@register("bars_full_range_1h", filled_sql(_SPARSE_SQL, 3600 * 1_000_000, full_range=True))
def q_bars_full_range_1h(spark, sf_dir):
    """Filled bars of symbols with idle days, which are filled too (Q4)."""
    day = F.dayofmonth("ts")
    t = V.events_trades(spark, sf_dir).where((day + F.length("symbol")) % 5 < 2)
    t = t.where(~((F.col("symbol") == "VIEWUSDT") & day.between(6, 24)))
    return round_sums(B.fill_bars(t, "1h", unique_ids=True, full_range=True))


# ---------------------------------------------------------------- dropped rows and guards

_DROP_SQL = f"""
SELECT CASE WHEN price IS NULL THEN 'price is null' WHEN isnan(price) THEN 'price is NaN' WHEN price <= 0 THEN 'price is not positive'
            WHEN ts IS NULL THEN 'time is null' WHEN is_buyer_maker IS NULL THEN 'is_buyer_maker is null' END AS reason,
       count(*) AS rows
FROM ({UNCLEAN_TRADES_SQL}) u GROUP BY 1 HAVING reason IS NOT NULL
UNION ALL SELECT 'malformed line', count(*) FROM events WHERE event_id % 31 = 9"""


@register("dropped_rows", _DROP_SQL)
def q_dropped_rows(spark, sf_dir):
    """Raw trade files with unclean rows and, beside them, files of malformed lines: how many rows the
    preprocessing left out and why, from its quarantine table (S1, P6)."""
    from ..plans.jobs import preprocess
    from ..session import shared_dir
    from ..sinks.files import land, write_csv_files, write_trade_files

    root, quarantine = shared_dir(spark, "unclean"), shared_dir(spark, "quarantine")
    unclean = V.events_unclean(spark, sf_dir)
    land(write_trade_files(unclean, root))
    bad = V.events_trades(spark, sf_dir).where(F.col("id") % 31 == 9)
    bad = bad.select(F.concat(F.lit("no number "), F.col("id").cast("string")).alias("id"), "price", "qty", "quote_qty", F.lit(0).alias("time"), "is_buyer_maker", "date")
    land(write_csv_files(bad, root, F.concat(F.lit("BADUSDT-trades-"), F.col("date").cast("string")), ["id", "price", "qty", "quote_qty", "time", "is_buyer_maker"]))
    preprocess(spark, root, shared_dir(spark, "trades"), quarantine=quarantine)
    return spark.read.parquet(quarantine).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "job_guards",
    f"""SELECT * FROM (VALUES ('missing folder', FALSE, CAST(0 AS BIGINT)), ('empty folder', FALSE, CAST(0 AS BIGINT)), ('header only', FALSE, CAST(0 AS BIGINT)))
       g(source, written, bars)
    UNION ALL SELECT 'one day', TRUE, count(*) FROM (SELECT DISTINCT symbol, date_trunc('hour', ts) FROM ({PREPARED_SQL}) p WHERE date = TIMESTAMP '2024-01-10') x""",
)
def q_job_guards(spark, sf_dir):
    """Both jobs over a missing folder, an empty one, a file without rows and one day of trades: what
    they wrote (S11)."""
    from ..plans.jobs import bars_job, preprocess
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files

    trades = V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp")))
    roots = {name: shared_dir(spark, "guard") for name in ("missing folder", "empty folder", "header only", "one day")}
    land(write_trade_files(trades.where(F.to_date("ts") == "2024-01-10"), roots["one day"]))
    trades.limit(0).select(*RAW_TRADE_COLUMNS).coalesce(1).write.option("header", True).csv(roots["header only"])
    spark.range(0).write.parquet(roots["empty folder"])
    out = None
    for name, root in roots.items():
        stored = shared_dir(spark, "guard-trades")
        written = preprocess(spark, root, stored)
        path = bars_job(spark, stored, shared_dir(spark, "guard-bars"), "1h", fill=False)
        bars = spark.range(0).select(F.lit(0)) if path is None else spark.read.parquet(path)
        row = bars.agg(F.lit(name).alias("source"), F.lit(written is not None and path is not None).alias("written"), F.count(F.lit(1)).alias("bars"))
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "kline_manifest",
    f"""WITH l AS ({_LANDED_SQL}),
    k AS (SELECT DISTINCT CASE WHEN contains(symbol, 'USDT') THEN symbol
                               WHEN suffix(symbol, '_PERP') THEN symbol
                               ELSE split_part(symbol, 'USDT', 1) || 'USD_PERP' END AS symbol,
                          CASE WHEN contains(symbol, 'USDT') THEN 'um' ELSE 'cm' END AS market, date FROM l)
    SELECT date, symbol, '{_ROOT}/' || market || '/daily/klines/' || symbol || '/1m/' || symbol || '-1m-' || date || '.zip' AS url, market
    FROM k""",
)
def q_kline_manifest(spark, sf_dir):
    from ..operators.manifest import kline_manifest, landed_files
    from ..sources.files import list_files

    landed = landed_files(list_files(spark, _landed_archives(spark, sf_dir), "*.zip"))
    return kline_manifest(landed, "1m", root=_ROOT)


@register(
    "manifest_missing",
    f"""SELECT m.* FROM ({MANIFEST_SQL}) m
    WHERE NOT EXISTS (SELECT 1 FROM ({_LANDED_SQL}) l WHERE l.symbol = m.symbol AND l.date = m.date)""",
)
def q_manifest_missing(spark, sf_dir):
    from ..operators.manifest import landed_files, missing_files
    from ..sources.files import list_files

    landed = landed_files(list_files(spark, _landed_archives(spark, sf_dir), "*.zip"))
    return missing_files(_manifest(spark, sf_dir), landed)


@register(
    "manifest_ledger",
    f"""SELECT 'first half' AS after, m.* FROM ({MANIFEST_SQL}) m
    WHERE NOT EXISTS (SELECT 1 FROM ({_LANDED_SQL}) l WHERE l.symbol = m.symbol AND l.date = m.date AND l.date < '2024-01-16')
    UNION ALL SELECT 'all', m.* FROM ({MANIFEST_SQL}) m
    WHERE NOT EXISTS (SELECT 1 FROM ({_LANDED_SQL}) l WHERE l.symbol = m.symbol AND l.date = m.date)""",
)
def q_manifest_ledger(spark, sf_dir):
    """Outstanding archives after each of two landings, from a ledger of landed files that a stream
    brings up to date: the second update lists the new files only (S10, M3, J6)."""
    from ..operators.manifest import landed_files, missing_files
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files
    from ..sources.files import update_listing

    root, ledger = shared_dir(spark, "archives"), shared_dir(spark, "ledger")
    trades = V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp")))
    out = None
    for after, part in (("first half", trades.where(F.col("date") < "2024-01-16")), ("all", trades.where(F.col("date") >= "2024-01-16"))):
        land(write_trade_files(part, root, archive=True))
        landed = _stored_rows(spark, landed_files(update_listing(spark, root, ledger, "*.zip")))
        missing = missing_files(_manifest(spark, sf_dir), landed).withColumn("after", F.lit(after))
        out = missing if out is None else out.unionByName(missing)
    return out


@register("archive_ingest", f"SELECT * FROM ({PREPARED_UNCLEAN_SQL}) p")
def q_archive_ingest(spark, sf_dir):
    """Zipped daily trade files -> prepared trades (S9 + L1 transforms).  Broken archives
    and a malformed line beside them add nothing."""
    from ..operators.prepare import prepare_trades
    from ..sources.files import ingest_archives

    root = _add_broken(spark, _landed_archives(spark, sf_dir, V.events_unclean(spark, sf_dir)))
    return check_view(prepare_trades(ingest_archives(spark, root)))


_KLINE_COLS = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count",
               "taker_buy_volume", "taker_buy_quote_volume", "ignore"]


def _landed_klines(spark, sf_dir) -> str:
    """Reference bars landed as exchange kline CSVs (one file per symbol-day); returns the folder."""
    from ..session import shared_dir
    from ..sinks.files import land, write_csv_files

    root = shared_dir(spark, "klines")
    ref = _reference_bars(spark, sf_dir)
    out = ref.select(
        "symbol",
        F.unix_millis(F.col("open_time").cast("timestamp")).alias("open_time"),
        "open", "high", "low", "close", "volume",
        F.unix_millis(F.col("close_time").cast("timestamp")).alias("close_time"),
        "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume",
        F.lit("0").alias("ignore"),
        F.to_date("open_time").alias("day"),
    )
    stem = F.concat(F.col("symbol"), F.lit("-1h-"), F.col("day").cast("string"))
    # Files of odd days order their columns the other way round.
    odd = F.dayofmonth("day") % 2 == 1
    land(write_csv_files(out.where(~odd), root, stem, _KLINE_COLS))
    land(write_csv_files(out.where(odd), root, stem, _KLINE_COLS[::-1]))
    return root


@register(
    "kline_scan",
    f"""SELECT symbol, open_time, open, high, low, close, {r4("volume")} AS volume, {r4("quote_volume")} AS quote_volume,
           "count", {r4("taker_buy_volume")} AS taker_buy_volume, {r4("taker_buy_quote_volume")} AS taker_buy_quote_volume
    FROM ({_REF_SQL}) r""",
)
def q_kline_scan(spark, sf_dir):
    """Reference bars landed as exchange kline CSVs, read back."""
    from ..sources.files import read_klines

    k = read_klines(spark, _landed_klines(spark, sf_dir))
    return round_sums(k)


@register("check_klines", verdict_sql(_GEN_SQL, _REF_SQL))
def q_check_klines(spark, sf_dir):
    """The check as run against downloaded klines: generated bars vs kline CSVs read from files."""
    from ..operators.quality import verdict
    from ..sources.files import read_klines

    return verdict(_generated_bars(spark, sf_dir), read_klines(spark, _landed_klines(spark, sf_dir)))


@register(
    "bars_job",
    f"""SELECT *, CAST(CAST(open_time AS DATE) AS TIMESTAMP) AS bucket
    FROM ({filled_sql(PREPARED_SQL, 3600 * 1_000_000)}) b""",
)
def q_bars_job(spark, sf_dir):
    """Whole flow on files: raw CSVs -> trades table -> 1-hour bars table -> read back (L1, L2, K2)."""
    from ..plans.jobs import bars_job, preprocess
    from ..schema import BAR_COLUMNS_WITH_BUCKET
    from ..session import shared_dir
    from ..sinks.files import land, write_trade_files

    raw_root = shared_dir(spark, "raw-trades")
    land(write_trade_files(V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp"))), raw_root))
    trades_root, bars_root = shared_dir(spark, "trades"), shared_dir(spark, "bars")
    preprocess(spark, raw_root, trades_root)
    out = bars_job(spark, trades_root, bars_root, "1h")
    bars = spark.read.parquet(out).select(*BAR_COLUMNS_WITH_BUCKET)
    return round_sums(bars.withColumn("open_time", F.col("open_time").cast("timestamp_ntz")).withColumn("close_time", F.col("close_time").cast("timestamp_ntz")))


# ---------------------------------------------------------------- more sources and jobs (S3, S9 status, S10, M3 counts, Q20)


def _prepared_table(spark, sf_dir) -> str:
    """Prepared events trades written as the partitioned trades table; returns its folder."""
    from ..operators.prepare import prepare_trades
    from ..session import shared_dir
    from ..sinks.tables import write_trades

    root = shared_dir(spark, "trades")
    write_trades(prepare_trades(V.events_raw_trades(spark, sf_dir)), root)
    return root


@register(
    "trades_scan",
    f"""SELECT symbol, ts, price, qty, quote_qty, is_buyer_maker, id, date FROM ({PREPARED_SQL}) p
    WHERE symbol IN ('VIEWUSDT', 'PURCHASEUSD_PERP')
      AND date >= TIMESTAMP '2024-01-10' AND date <= TIMESTAMP '2024-01-20'""",
)
def q_trades_scan(spark, sf_dir):
    """Stored trades read back with symbol and date filters on the partition columns."""
    from ..sources.trades import load_trades

    df = load_trades(spark, _prepared_table(spark, sf_dir), symbols=["VIEWUSDT", "PURCHASEUSD_PERP"],
                     start_date="2024-01-10", end_date="2024-01-20")
    return check_view(df)


@register(
    "archive_status",
    f"""SELECT symbol || '-trades-' || strftime(date, '%Y-%m-%d') AS stem, TRUE AS ok,
           CAST(count(*) + 1 AS BIGINT) AS lines
    FROM ({EVENTS_TRADES_SQL}) t GROUP BY symbol, date
    UNION ALL SELECT * FROM (VALUES ('CUTUSDT-trades-2024-01-10', FALSE, CAST(0 AS BIGINT)), ('CRCUSDT-trades-2024-01-10', FALSE, CAST(0 AS BIGINT)),
                                    ('EXTRAUSDT-trades-2024-01-10', TRUE, CAST(2 AS BIGINT))) x""",
)
def q_archive_status(spark, sf_dir):
    """Per landed archive: readable, and lines read (header included) (S9 status)."""
    from ..functions.names import file_name
    from ..sources.files import archive_lines, archive_status

    st = archive_status(archive_lines(spark, _add_broken(spark, _landed_archives(spark, sf_dir))))
    stem = F.regexp_replace(file_name(F.col("archive")), r"(-p[0-9]+)?\.zip$", "")
    # The writer emits one archive per (symbol, day) and task, each with a
    # header line: fold a day's parts together and count its header once.
    folded = st.groupBy(stem.alias("stem")).agg(
        F.bool_and("ok").alias("ok"), F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("parts")
    )
    return folded.select("stem", "ok", (F.col("lines") - F.col("parts") + 1).cast("bigint").alias("lines"))


@register("landed_files", f"SELECT DISTINCT symbol, date FROM ({_LANDED_SQL}) l")
def q_landed_files(spark, sf_dir):
    """Landed archive names parsed to (symbol, date)."""
    from ..operators.manifest import landed_files
    from ..sources.files import list_files

    return landed_files(list_files(spark, _landed_archives(spark, sf_dir), "*.zip")).select("symbol", "date").distinct()


@register(
    "manifest_summary",
    f"""WITH m AS ({MANIFEST_SQL}),
    miss AS (SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM ({_LANDED_SQL}) l WHERE l.symbol = m.symbol AND l.date = m.date))
    SELECT m.market, count(*) AS expected, count(*) - (SELECT count(*) FROM miss) AS landed, (SELECT count(*) FROM miss) AS missing
    FROM m GROUP BY m.market""",
)
def q_manifest_summary(spark, sf_dir):
    """Expected / landed / missing archive counts per market (M3)."""
    from ..operators.manifest import landed_files, missing_summary
    from ..sources.files import list_files

    landed = landed_files(list_files(spark, _landed_archives(spark, sf_dir), "*.zip"))
    return missing_summary(_manifest(spark, sf_dir), landed)


def _stored_rows(spark, df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    from ..session import shared_dir

    path = shared_dir(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@register(
    "bars_job_rerun",
    f"""SELECT *, CAST(CAST(open_time AS DATE) AS TIMESTAMP) AS bucket
    FROM ({filled_sql(PREPARED_SQL, 3600 * 1_000_000)}) b""",
)
def q_bars_job_rerun(spark, sf_dir):
    """Bars job over all days, then again for the file dates 2024-01-05, 2024-01-20 and 2024-01-12 after
    the stored bars of the days that their trades touch were falsified.  The last three hours of each
    day are in the next day's file, so a rerun recomputes two days whole, from three files, or one
    where those hours had no trade; the other days stay as they were (L2, K3, Q20)."""
    from ..operators.prepare import prepare_trades
    from ..plans.jobs import bars_job
    from ..schema import BAR_COLUMNS_WITH_BUCKET
    from ..session import shared_dir
    from ..sinks.tables import write_bars, write_trades
    from ..sinks.zones import touched, update_zones

    late = V.events_trades(spark, sf_dir, late_hours=3).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp")))
    trades_root, bars_root = shared_dir(spark, "trades"), shared_dir(spark, "bars")
    write_trades(prepare_trades(V.raw_of(late)), trades_root)
    out = bars_job(spark, trades_root, bars_root, "1h")
    reruns, zones = ("2024-01-05", "2024-01-20", "2024-01-12"), update_zones(spark, trades_root)
    days = sorted({day for date in reruns for day in touched(zones, None, date, date)[0]})
    stored = spark.read.parquet(out)
    wrong = stored.where(F.col("bucket").isin(days)).withColumn("high", F.col("high") + 1)
    write_bars(_stored_rows(spark, wrong), bars_root, "1h")
    for day in reruns:
        bars_job(spark, trades_root, bars_root, "1h", start_date=day, end_date=day)
    bars = spark.read.parquet(out).select(*BAR_COLUMNS_WITH_BUCKET)
    return round_sums(bars.withColumn("open_time", F.col("open_time").cast("timestamp_ntz")).withColumn("close_time", F.col("close_time").cast("timestamp_ntz")))


@register(
    "bars_job_append",
    f"""SELECT *, CAST(CAST(open_time AS DATE) AS TIMESTAMP) AS bucket
    FROM ({filled_sql(PREPARED_SQL, 3600 * 1_000_000)}) b""",
)
def q_bars_job_append(spark, sf_dir):
    """Bars job appended twice over all days, and a third run over some of them: read back, each
    (symbol, day) is there once, of its latest run (L2, Q6)."""
    from ..plans.jobs import bars_job
    from ..schema import BAR_COLUMNS_WITH_BUCKET
    from ..session import shared_dir
    from ..sources.trades import load_bars

    trades_root, bars_root = _prepared_table(spark, sf_dir), shared_dir(spark, "bars")
    for run in (1, 2):
        bars_job(spark, trades_root, bars_root, "1h", mode="append", run=run)
    bars_job(spark, trades_root, bars_root, "1h", mode="append", run=3, start_date="2024-01-07", end_date="2024-01-09")
    bars = load_bars(spark, bars_root, "1h").select(*BAR_COLUMNS_WITH_BUCKET)
    return round_sums(bars.withColumn("open_time", F.col("open_time").cast("timestamp_ntz")).withColumn("close_time", F.col("close_time").cast("timestamp_ntz")))


@register(
    "table_file_order",
    f"""SELECT symbol, CAST(CAST(open_time AS DATE) AS TIMESTAMP) AS bucket, count(*) AS rows, CAST(0 AS BIGINT) AS inversions
    FROM ({_FILLED_1M}) b GROUP BY 1, 2""",
)
def q_table_file_order(spark, sf_dir):
    """Rows of a written bars table that come before an earlier one in their file (K5)."""
    from pyspark.sql import Window

    bars = B.compute_bars(V.events_trades(spark, sf_dir), "1m", fill=True, unique_ids=True)
    rows = _stored(spark, bars, "1m").select("symbol", "bucket", "open_time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("open_time").over(Window.partitionBy("file").orderBy("i"))
    out = rows.withColumn("wrong", (before > F.col("open_time")).cast("int"))
    return check_view(out.groupBy("symbol", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("wrong"), F.lit(0).cast("long")).alias("inversions")))


@register("chart_files", CHART_SQL)
def q_chart_files(spark, sf_dir):
    """Chart payloads written as JSON, one folder per symbol, and read back (K7)."""
    from ..session import shared_dir
    from ..sinks.files import write_chart_series

    series = q_chart_series(spark, sf_dir)
    path = write_chart_series(series, shared_dir(spark, "charts"))
    return spark.read.schema(series.schema).json(path).select(*series.columns)


@register("check_flow", verdict_sql(filled_sql(PREPARED_SQL, 3600 * 1_000_000, rounded=False), _REF_SQL))
def q_check_flow(spark, sf_dir):
    """Archives -> trades table -> bars table -> comparison with kline files (L3)."""
    from ..plans.jobs import check_flow
    from ..session import shared_dir

    frames = check_flow(spark, _landed_archives(spark, sf_dir), _landed_klines(spark, sf_dir), shared_dir(spark, "flow"), "1h")
    return frames["verdict"]


_SEED_SQL = f"SELECT symbol, first(price ORDER BY ts, id, price) AS seed FROM ({EVENTS_TRADES_SQL}) t GROUP BY symbol"
_NULL_GEN = filled_sql(EVENTS_TRADES_SQL, 300 * 1_000_000, rounded=False)
_NULL_REF = filled_sql(EVENTS_TRADES_SQL, 300 * 1_000_000, rounded=False, seed_sql=_SEED_SQL)
_NULLS_JOINED = f"""
  SELECT coalesce(g.symbol, r.symbol) AS symbol, coalesce(g.open_time, r.open_time) AS open_time, g.*, r.*
  FROM ({_proj_sql(_NULL_GEN, 'gen')}) g FULL OUTER JOIN ({_proj_sql(_NULL_REF, 'ref')}) r
    ON g.symbol = r.symbol AND g.open_time = r.open_time"""


@register(
    "check_nulls",
    f"""WITH j AS (SELECT * EXCLUDE (symbol, open_time), symbol, open_time FROM ({_NULLS_JOINED}) x),
    l AS ({_LONG_SQL})
    SELECT * FROM l WHERE (generated IS NULL) <> (reference IS NULL)""",
)
def q_check_nulls(spark, sf_dir):
    """Null versus value on aligned bars (Q14): unseeded fill vs fill seeded with each symbol's first price."""
    from ..operators.quality import null_mismatches

    t = V.events_trades(spark, sf_dir)
    seed = t.groupBy("symbol").agg(F.min(F.struct("ts", "id", "price"))["price"].alias("close"))
    gen = B.fill_bars(t, "5m", unique_ids=True)
    ref = B.fill_bars(t, "5m", unique_ids=True, seed_close=seed)
    return null_mismatches(gen, ref)


# ---------------------------------------------------------------- streaming (bars over a trade stream)


@register("stream_bars_1h", _unfilled(EVENTS_TRADES_SQL, 3600))
def q_stream_bars_1h(spark, sf_dir):
    """1-hour bars from a Structured Streaming run over the events trades, landed as
    four files in no order of time and read one per micro-batch.  A trade may come as late
    as the trades span, which the watermark allows for; bars are upserted as they change, so all are there."""
    from ..session import shared_dir
    from ..streaming.bars import current_bars, stream_bars, upsert_bars

    root = shared_dir(spark, "stream")
    trades = V.events_trades(spark, sf_dir)
    trades.repartition(4, F.xxhash64("id")).write.parquet(f"{root}/in")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = spark.read.schema(trades.schema).parquet(f"{root}/in").agg(F.max(micros) - F.min(micros)).first()[0] or 0
    source = spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    upsert_bars(stream_bars(source, "1h", watermark=f"{span // 1_000_000 + 1} seconds"), f"{root}/checkpoint", f"{root}/out")
    return round_sums(current_bars(spark, f"{root}/out").select(*BAR_COLUMNS))
