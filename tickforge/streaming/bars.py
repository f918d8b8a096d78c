"""Bars over a trade stream (Structured Streaming).

Same aggregate expressions as batch ``aggregate_bars``; the event time is
cast to TIMESTAMP (watermarks reject TIMESTAMP_NTZ).  The watermark bounds how
late a trade may come and with it the state.  Bars are emitted in update mode
whenever they change and kept by key, so that open bars are there too.  Gap
filling stays a batch step over the stored bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from ..functions.timeframe import parse_timeframe
from ..operators.bars import _bar_aggregates, _vwap
from ..schema import BAR_COLUMNS


def stream_bars(trades: DataFrame, timeframe, watermark: str = "10 minutes", ts_col: str = "ts", unique_ids: bool = False) -> DataFrame:
    """Streaming unfilled bars (``symbol, open_time, close_time, ...``).

    ``open_time``/``close_time`` are TIMESTAMP (the stream's event-time type).
    """
    tf = parse_timeframe(timeframe)
    et = F.col("_event_time")
    s = trades.withColumn("_event_time", F.col(ts_col).cast("timestamp")).withWatermark("_event_time", watermark)
    grouped = s.groupBy("symbol", F.window(et, f"{tf.seconds} seconds").alias("bar"))
    aggs = _bar_aggregates(
        F.col("price"), F.col("qty"), F.col("quote_qty"), ~F.col("is_buyer_maker"), et, epoch_micros(et), F.col("id"), unique_ids
    )
    out = grouped.agg(*aggs).withColumn("vwap", _vwap(F.col("weighted_price"), F.col("quote_volume")))
    return out.select(
        "symbol",
        F.col("bar.start").alias("open_time"),
        (F.col("bar.end") - F.expr("INTERVAL 1 MICROSECOND")).alias("close_time"),
        *BAR_COLUMNS[3:],
    )


def upsert_bars(bars: DataFrame, checkpoint: str, path: str, available_now: bool = True):
    """Keeps the bars of a stream at ``path``: every micro-batch writes the bars it changed
    (update mode) to a folder of its own, ``batch_id=n``.  A batch that is run
    again overwrites its folder, so each takes effect once.  ``current_bars`` reads the result."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def current_bars(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every bar written by ``upsert_bars``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in ("symbol", "open_time", "batch_id")]
    latest = rows.groupBy("symbol", "open_time").agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return latest.select("symbol", "open_time", "v.*")
