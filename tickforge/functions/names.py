"""File-name and symbol conventions as column expressions.

Raw trade files are named ``{symbol}-trades-{yyyy-MM-dd}.csv`` (archives
``.zip``).  Symbols ending in ``_PERP`` are coin-margined (market ``cm``),
all others USD-margined (``um``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the naming convention.
TRADES_MARK = "-trades-"
DATE_IN_NAME = r"-trades-([0-9]{4}-[0-9]{2}-[0-9]{2})"
PATH_SEPARATORS = r"[\\/]+"
CM_MARK = "_PERP"
MARKET_CM = "cm"
MARKET_UM = "um"


def file_name(path: Column) -> Column:
    """Last segment of a path split on ``/`` or ``\\`` (no regex: the last
    segment of a split on separator runs is the text after the last separator)."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def symbol_from_name(name: Column) -> Column:
    """Text before ``-trades-`` (the whole name when absent)."""
    return F.substring_index(name, TRADES_MARK, 1)


def date_from_name(name: Column) -> Column:
    """Date after ``-trades-``; null when the name holds none."""
    # The regex admits only dddd-dd-dd, so a plain cast parses it exactly
    # (no formatter); impossible dates and '' (no match) become null.
    return F.regexp_extract(name, DATE_IN_NAME, 1).try_cast("date")


def market_of(symbol: Column) -> Column:
    return F.when(F.upper(symbol).contains(CM_MARK), F.lit(MARKET_CM)).otherwise(F.lit(MARKET_UM))
