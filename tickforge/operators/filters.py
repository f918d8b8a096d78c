"""Row filters on symbol and date columns (partition columns of the stored tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_date(value) -> dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value), "%Y-%m-%d").date()


def filter_symbols(df: DataFrame, symbols=None, col: str = "symbol") -> DataFrame:
    """Keeps listed symbols; an empty or missing list keeps all."""
    if not symbols:
        return df
    return df.where(F.col(col).isin(list(symbols)))


def filter_date_range(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Inclusive date range; either bound may be omitted."""
    lo, hi = _as_date(start), _as_date(end)
    if lo is not None:
        df = df.where(F.col(col) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(col) <= F.lit(hi))
    return df


def filter_buckets(df: DataFrame, start, end=None, col: str = "bucket") -> DataFrame:
    """Inclusive ``bucket`` range for bar tables; ``end`` defaults to ``start``."""
    lo = _as_date(start)
    hi = _as_date(end) if end is not None else lo
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))
