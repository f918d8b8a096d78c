"""Zone map of a stored trades table: which days the trades of each stored partition touch.

A row per (symbol, file date, day of the trades' own time): how many trades, first and
last time.  It is kept under ``_zones`` in the table's folder, which readers of the table pass
over, as generations: a row counts if its generation is the latest of its partition.
A run that needs some days finds the partitions that hold them without opening a trade file.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ZONES_DDL = "symbol string, date date, day date, trades long, first_ts timestamp_ntz, last_ts timestamp_ntz, changed timestamp, generation long"


def zones_path(path: str) -> str:
    return f"{path.rstrip('/')}/_zones"


def _generations(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(ZONES_DDL).parquet(zones_path(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], ZONES_DDL)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The current rows: symbol, date, day, trades, first_ts, last_ts."""
    latest = Window.partitionBy("symbol", "date")
    rows = _generations(spark, path).withColumn("_g", F.max("generation").over(latest))
    return rows.where(F.col("generation") == F.col("_g")).drop("_g", "generation", "changed")


def update_zones(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Brings the zone map up to the stored files and returns its current rows.

    Only partitions with a file as new as the newest one known, or newer, are read, and of them
    ``ts`` alone.  A table that never had a map is read once.
    """
    known = _generations(spark, path).agg(F.max("changed"), F.max("generation")).first()
    stored = spark.read.format(fmt).load(path)
    changed = F.col("_metadata.file_modification_time")
    new = stored if known[0] is None else stored.where(changed >= F.lit(known[0]))
    parts = new.select("symbol", "date").distinct()
    rows = stored.select("symbol", "date", F.col("ts").cast("timestamp_ntz").alias("ts"), changed.alias("changed"))
    if known[0] is not None:
        rows = rows.join(parts, ["symbol", "date"], "left_semi")
    fresh = rows.where(F.col("ts").isNotNull()).groupBy("symbol", "date", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("trades"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.max("changed").alias("changed")
    )
    generation = max(time.time_ns(), (known[1] or 0) + 1)
    fresh.withColumn("generation", F.lit(generation)).coalesce(1).write.mode("append").parquet(zones_path(path))
    return read_zones(spark, path)


def touched(zones: DataFrame, symbols=None, start_date=None, end_date=None) -> tuple[list, list]:
    """(days, file dates): the days that the trades filed under the given dates touch, and every
    file date that holds trades of those days.  Both are sorted lists of dates, at most one per
    calendar day."""
    from ..operators.filters import filter_date_range, filter_symbols

    zones = filter_symbols(zones, symbols)
    days = filter_date_range(zones, start_date, end_date).select("day").distinct()
    dates = zones.join(days, "day", "left_semi").select("date").distinct()
    return sorted(r[0] for r in days.collect()), sorted(r[0] for r in dates.collect())
