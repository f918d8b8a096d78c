"""Trade-count report and chart series.

The report first reduces trades to counts per (symbol, date) - one partial
aggregate - and does every later step (totals, pivot, text formatting) on
that small table.  No step gathers rows in one task: widths are aggregates per
column, lines are assembled per row, and ordering is a (section, symbol) key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import filter_buckets, filter_date_range, filter_symbols
from ..session import shared_dir

TOTAL = "Total"
#: Fixed value: the first line of the report.
REPORT_TITLE = "  Asset Metrics - Trade Count per Symbol / Day"


def trade_counts(trades: DataFrame, symbols=None, start=None, end=None) -> DataFrame:
    """(symbol, date, trade_count), one aggregate; sort by (symbol, date) to show it."""
    df = filter_date_range(filter_symbols(trades, symbols), start, end)
    return df.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("trade_count"))


def trade_count_totals(counts: DataFrame) -> DataFrame:
    """Long form with totals: (symbol, day, trade_count) where ``symbol`` or
    ``day`` is 'Total' on total rows; ``day`` is the date as yyyy-MM-dd text.

    ``cube`` over the per-(symbol, date) counts gives per-symbol totals,
    per-date totals and the grand total in one aggregate.
    """
    day = F.col("date").cast("string")
    cubed = counts.select("symbol", day.alias("day"), "trade_count").cube("symbol", "day").agg(
        F.sum("trade_count").cast("bigint").alias("trade_count"),
        F.grouping("symbol").alias("_gs"),
        F.grouping("day").alias("_gd"),
    )
    return cubed.select(
        F.when(F.col("_gs") == 1, F.lit(TOTAL)).otherwise(F.col("symbol")).alias("symbol"),
        F.when(F.col("_gd") == 1, F.lit(TOTAL)).otherwise(F.col("day")).alias("day"),
        "trade_count",
    )


def report_days(counts: DataFrame) -> list[str]:
    """Distinct dates as text, ascending (bounded by the calendar, not the data)."""
    rows = counts.select(F.col("date").cast("string").alias("d")).distinct().collect()
    return sorted(r["d"] for r in rows)


def _settled(counts: DataFrame, days: list[str] | None) -> tuple[DataFrame, list[str]]:
    """The counts and their dates.  Where the dates are not given, the counts, one row per
    (symbol, date), are written once, so that the trades behind them are read once."""
    if days is None:
        path = shared_dir(counts.sparkSession, "trade-counts")
        counts.write.parquet(path)
        counts = counts.sparkSession.read.schema(counts.schema).parquet(path)
        days = report_days(counts)
    return counts, days


def trade_count_matrix(counts: DataFrame, days: list[str] | None = None, zero_missing: bool = True) -> DataFrame:
    """Wide matrix: one row per symbol plus a 'Total' row; one column per
    date (ascending) plus 'Total'.  Missing cells are 0 when ``zero_missing``.

    Passing ``days`` saves the job that finds the pivot values.
    """
    counts, days = _settled(counts, days)
    long = trade_count_totals(counts)
    wide = long.groupBy("symbol").pivot("day", days + [TOTAL]).agg(F.first("trade_count"))
    cols = [F.col("symbol")]
    for d in days + [TOTAL]:
        c = F.col(f"`{d}`")
        cols.append((F.coalesce(c, F.lit(0)) if zero_missing else c).cast("bigint").alias(d))
    return wide.select(*cols)


def _fmt(v):
    return F.format_number(F.coalesce(v, F.lit(0)).cast("bigint"), 0)


def trade_count_report(counts: DataFrame, days: list[str] | None = None) -> DataFrame:
    """The formatted report as text lines: (section, symbol, line).

    Order lines by (section, symbol): 0 title, 1 rule, 2 header, 3 rule,
    4 symbol rows, 5 rule, 6 Total row, 7 rule.  Cells are right-aligned to the
    widest value or header of their column plus two blanks; numbers carry
    thousands separators and missing counts print as 0.
    """
    counts, days = _settled(counts, days)
    columns = ["symbol"] + days + [TOTAL]
    order = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])

    long = trade_count_totals(counts)
    # Every (row, column) cell, including empty ones, as text.
    row_keys = long.select("symbol").distinct()
    grid = row_keys.select("symbol", F.explode(F.array(*[F.lit(d) for d in days + [TOTAL]])).alias("day"))
    cells = grid.join(long, ["symbol", "day"], "left").select("symbol", "day", _fmt(F.col("trade_count")).alias("text"))
    cells = cells.unionByName(row_keys.select("symbol", F.lit("symbol").alias("day"), F.col("symbol").alias("text")))

    widths = cells.groupBy("day").agg(F.max(F.length("text")).alias("w")).select(
        "day", (F.greatest(F.col("w"), F.length("day")) + 2).alias("w")
    )
    padded = cells.join(widths, "day").select("symbol", order[F.col("day")].alias("pos"), F.lpad("text", F.col("w"), " ").alias("cell"))
    body = padded.groupBy("symbol").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cell"))), lambda x: x["cell"]), "").alias("line")
    )
    header_cells = widths.select(order[F.col("day")].alias("pos"), F.lpad(F.col("day"), F.col("w"), " ").alias("cell"), "w")
    header = header_cells.groupBy().agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cell"))), lambda x: x["cell"]), "").alias("line"),
        F.sum("w").alias("width"),
    )
    rule = F.repeat(F.lit("-"), F.col("width").cast("int"))
    frame = header.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("section"), F.lit(REPORT_TITLE).alias("line")),
                F.struct(F.lit(1).alias("section"), rule.alias("line")),
                F.struct(F.lit(2).alias("section"), F.col("line").alias("line")),
                F.struct(F.lit(3).alias("section"), rule.alias("line")),
                F.struct(F.lit(5).alias("section"), rule.alias("line")),
                F.struct(F.lit(7).alias("section"), rule.alias("line")),
            )
        ).alias("s")
    ).select("s.section", F.lit(None).cast("string").alias("symbol"), "s.line")
    rows = body.select(
        F.when(F.col("symbol") == TOTAL, F.lit(6)).otherwise(F.lit(4)).alias("section"),
        F.when(F.col("symbol") == TOTAL, F.lit(None).cast("string")).otherwise(F.col("symbol")).alias("symbol"),
        "line",
    )
    return frame.unionByName(rows)


def chart_series(bars: DataFrame, symbols, interval: str, start: str, end: str | None = None) -> DataFrame:
    """Chart-ready series, one row per (symbol, bucket day) so no group grows
    past one day of bars: arrays open_time (text), open, high, low, close,
    volume, vwap in time order, with the chart title, output file stem and
    axis label (symbol before 'USDT') of the symbol's chart."""
    end = end or start
    df = filter_buckets(filter_symbols(bars, symbols), start, end)
    point = F.struct(
        F.col("open_time").alias("t"),
        F.date_format("open_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("open_time"),
        "open", "high", "low", "close", "volume", "vwap",
    )
    grouped = df.groupBy("symbol", "bucket").agg(F.array_sort(F.collect_list(point)).alias("p"))
    span = f"({start})" if start == end else f"({start} to {end})"
    stem = f"_ohlc_{start}" if start == end else f"_ohlc_{start}_to_{end}"
    return grouped.select(
        "symbol",
        "bucket",
        F.concat(F.col("symbol"), F.lit(f" OHLC - {interval} Bars {span}")).alias("title"),
        F.concat(F.lower("symbol"), F.lit(stem)).alias("file_stem"),
        F.substring_index("symbol", "USDT", 1).alias("axis_symbol"),
        *[F.transform("p", _field(c)).alias(c) for c in ["open_time", "open", "high", "low", "close", "volume", "vwap"]],
    )


def _field(name: str):
    return lambda x: x[name]

