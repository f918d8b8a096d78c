"""File manifests and their reconciliation with landed files.

A manifest lists, per day and symbol, the archive expected from the exchange.
Days come from ``sequence`` + ``explode`` on each symbol row (no join); the
reconciliation is an anti join keyed on (symbol, date) parsed from file names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.timeframe import parse_timeframe

# Market suffixes and URL layouts (the host is a parameter).
UM_SYMBOL_SUFFIX = "T"
CM_SYMBOL_SUFFIX = "_PERP"
CM_KLINE_SUFFIX = "USD_PERP"
USDT = "USDT"
TRADES_LAYOUT = "{root}/{market}/daily/trades/{symbol}/{symbol}-trades-{d}.zip"
KLINES_LAYOUT = "{root}/{market}/daily/klines/{symbol}/{bar}/{symbol}-{bar}-{d}.zip"
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"


def _template(layout: str, **parts: Column) -> Column:
    """Fill ``{name}`` slots of a layout with column values (JVM-side concat)."""
    pieces: list[Column] = []
    rest = layout
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            pieces.append(F.lit(head))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


def _as_date(v) -> dt.date:
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v))


def file_manifest(
    symbols: DataFrame,
    start,
    end,
    market: str = "um",
    day_step: int = 1,
    root: str = "https://data.example/futures",
    layout: str = TRADES_LAYOUT,
) -> DataFrame:
    """(date, symbol, url, market) for every day from ``start`` to ``end`` (step
    ``day_step``) and every base symbol in ``symbols.symbol``.  Market 'um'
    appends 'T' to the base, any other market '_PERP'."""
    s, e = _as_date(start), _as_date(end)
    suffix = UM_SYMBOL_SUFFIX if market == "um" else CM_SYMBOL_SUFFIX
    days = F.sequence(F.lit(s), F.lit(e), F.expr(f"INTERVAL {int(day_step)} DAY"))
    rows = symbols.select(F.concat(F.col("symbol"), F.lit(suffix)).alias("symbol"), F.explode(days).alias("d"))
    day = F.col("d").cast("string")
    url = _template(layout, root=F.lit(root), market=F.lit(market), symbol=F.col("symbol"), d=day)
    return rows.select(day.alias("date"), "symbol", url.alias("url"), F.lit(market).alias("market"))


def manifest_document(manifest: DataFrame, start, end) -> DataFrame:
    """One JSON-shaped row per market and date: market, start, end, entries[date, symbol, url].

    ``start`` and ``end`` are those of the request; the entries array holds the
    symbols of one day, sorted.
    """
    entry = F.struct("date", "symbol", "url")
    return manifest.groupBy("market", "date").agg(F.array_sort(F.collect_list(entry)).alias("entries")).select(
        "market", F.lit(str(_as_date(start))).alias("start"), F.lit(str(_as_date(end))).alias("end"), "entries"
    )


def manifest_urls(document: DataFrame) -> DataFrame:
    """Entries of manifest documents that carry a url: (market, date, symbol, url)."""
    e = document.select("market", F.explode("entries").alias("e"))
    return e.select("market", "e.date", "e.symbol", "e.url").where(F.col("url").isNotNull())


def landed_files(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Landed file names -> (file, symbol, date): symbol is the name up to the
    first '-', date the first yyyy-MM-dd in the name; names without a date are skipped."""
    name = N.file_name(F.col(path_col))
    day = F.regexp_extract(name, DATE_PATTERN, 0)
    return listing.select(name.alias("file"), F.substring_index(name, "-", 1).alias("symbol"), day.alias("date")).where(
        F.col("date") != ""
    )


def kline_manifest(landed: DataFrame, bar: str = "1m", root: str = "https://data.example/futures", layout: str = KLINES_LAYOUT) -> DataFrame:
    """Expected reference-bar archives for landed trade files.

    Symbols holding 'USDT' are 'um' and keep their name; others are 'cm':
    a name already ending in '_PERP' is kept, any other gets its part before
    'USDT' followed by 'USD_PERP'.
    """
    parse_timeframe(bar)  # reject durations the bars job would reject
    sym = F.col("symbol")
    is_um = sym.contains(USDT)
    kline_symbol = (
        F.when(is_um, sym)
        .when(sym.endswith(CM_SYMBOL_SUFFIX), sym)
        .otherwise(F.concat(F.substring_index(sym, USDT, 1), F.lit(CM_KLINE_SUFFIX)))
    )
    market = F.when(is_um, F.lit("um")).otherwise(F.lit("cm"))
    rows = landed.select(kline_symbol.alias("symbol"), market.alias("market"), "date").distinct()
    url = _template(layout, root=F.lit(root), market=F.col("market"), symbol=F.col("symbol"), bar=F.lit(bar), d=F.col("date"))
    return rows.select("date", "symbol", url.alias("url"), "market")


def missing_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest entries with no landed file for the same (symbol, date).

    Landed names are parsed by ``landed_files`` (symbol up to the first '-',
    first date in the name), so split or renamed parts still count.
    """
    have = landed.select("symbol", "date").distinct()
    return manifest.join(have, ["symbol", "date"], "left_anti")


def missing_summary(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Per market: expected, landed and missing archive counts."""
    miss = missing_files(manifest, landed).groupBy("market").agg(F.count(F.lit(1)).alias("missing"))
    total = manifest.groupBy("market").agg(F.count(F.lit(1)).alias("expected"))
    out = total.join(miss, "market", "left").select("market", "expected", F.coalesce("missing", F.lit(0)).alias("missing"))
    return out.select("market", "expected", (F.col("expected") - F.col("missing")).alias("landed"), "missing")
