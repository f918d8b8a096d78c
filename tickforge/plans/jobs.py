"""Whole jobs: raw files -> trades table -> bars table (+ checks).

Each job is a function of its inputs (no config files).  Empty or missing
inputs write nothing and return ``None``; otherwise the output path.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timeframe import parse_timeframe
from ..operators.bars import compute_bars
from ..operators.prepare import DEFAULT_CM_RATIO, prepare_trades, reasoned
from ..session import ensure_utc
from ..sinks.tables import RUN, write_bars, write_trades
from ..sinks.zones import touched, update_zones
from ..sources.trades import load_trades, read_trades

log = logging.getLogger(__name__)


def _missing(exc: AnalysisException) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text


def preprocess(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    ratio: float = DEFAULT_CM_RATIO,
    num_partitions: int | None = None,
    max_records: int | None = None,
    partition_cols=("symbol", "date"),
    mode: str = "overwrite",
    fmt: str = "parquet",
    sort_within_partitions: bool = True,
    header: bool = True,
    quarantine: str | None = None,
) -> str | None:
    """Raw trade CSVs -> prepared, partitioned trades table.

    With ``quarantine``, a path, the rows that are left out are counted by reason in the
    pass that writes the table, and logged; if there are any, they are written there,
    with ``reason`` and their file, and replace what was there before.
    """
    ensure_utc(spark)
    try:
        raw = read_trades(spark, input_path, header=header, bad_col=None if quarantine is None else "_bad")
        if raw.isEmpty():
            log.warning("no trade rows in the files of %s", input_path)
            return None
    except AnalysisException as exc:
        if _missing(exc):
            log.warning("no folder %s", input_path)
            return None
        raise
    if quarantine is not None:
        rejected = Observation("rejected")
        rows = reasoned(raw, ratio)
        raw = rows.observe(rejected, F.count("reason").alias("rows")).where(F.col("reason").isNull()).drop("reason", "_bad")
    trades = prepare_trades(raw, ratio)
    out = write_trades(
        trades, output_path, fmt=fmt, mode=mode, partition_cols=partition_cols,
        num_partitions=num_partitions, max_records=max_records,
        sort_within_partitions=sort_within_partitions,
    )
    if quarantine is not None:
        log.warning("%s rows of %s left out", rejected.get["rows"], input_path)
        some = rows if rejected.get["rows"] else rows.limit(0)
        some.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(quarantine)
    return out


def seed_from_bars(spark: SparkSession, bars_path: str, before, symbols=None, fmt: str = "parquet") -> DataFrame | None:
    """(symbol, close, day): the last valid close per symbol from stored bars dated before
    ``before``, a date, or before the first day of each run of days of a list of dates,
    whose own days are passed over.

    Reads no history: each symbol's latest stored ``bucket`` before a run comes from
    the partition values alone (no data column is touched), and only those buckets are
    read.  The join on the partition columns lets dynamic partition pruning skip
    every other directory.  In tables written by the bars job every stored day after a
    symbol's first trade has a valid close (filled slots carry it; prepared trades
    hold no NaN), so the latest day is enough.
    """
    import datetime as dt

    from ..operators.filters import _as_date, filter_symbols

    days = [_as_date(d) for d in (before if isinstance(before, (list, tuple)) else [before])]
    starts = sorted(d for d in days if d - dt.timedelta(days=1) not in set(days))
    try:
        stored = filter_symbols(spark.read.format(fmt).load(bars_path), symbols)
    except AnalysisException as exc:
        if _missing(exc):
            return None
        raise
    newest_run = F.coalesce(RUN, F.lit(-1)) if RUN in stored.columns else F.lit(-1)
    older = stored.where(F.col("bucket") < F.lit(starts[-1]))
    if between := [d for d in days if d < starts[-1]]:
        older = older.where(~F.col("bucket").isin(between))
    run = F.array_min(F.filter(F.array(*[F.lit(d) for d in starts]), lambda d: d > F.col("bucket")))
    last_bucket = older.select("symbol", "bucket").groupBy("symbol", run.alias("_run")).agg(F.max("bucket").alias("bucket")).select("symbol", "bucket")
    last_rows = older.join(last_bucket, ["symbol", "bucket"])
    valid = F.col("close").isNotNull() & ~F.isnan("close")
    close = F.max_by(F.when(valid, F.col("close")), F.when(valid, F.struct(newest_run, "open_time"))).alias("close")
    return last_rows.groupBy("symbol", F.col("bucket").alias("day")).agg(close).select("symbol", "close", "day")


def bars_frame(
    spark: SparkSession,
    trades_path: str,
    timeframe,
    fill: bool = True,
    fmt: str = "parquet",
    symbols=None,
    days: list | None = None,
    file_dates: list | None = None,
    unique_ids: bool = False,
    seed_close: DataFrame | None = None,
) -> DataFrame | None:
    """Bars with ``bucket`` from a stored trades table (the symbol filter prunes partitions).

    ``days`` (a list of dates) limits the trades by their own time, whatever file date
    they are stored under, so every bar of those days is complete; ``file_dates`` are
    the file dates that hold them all, and prune the scan.
    ``seed_close`` (symbol, close, day) carries closes from days that are not read,
    e.g. ``seed_from_bars`` when ``days`` cuts history."""
    ensure_utc(spark)
    try:
        trades = load_trades(spark, trades_path, fmt, symbols)
    except AnalysisException as exc:
        if _missing(exc):
            log.warning("nothing stored at %s", trades_path)
            return None
        raise
    if days is not None:
        if file_dates is not None:
            trades = trades.where(F.col("date").isin(file_dates))
        trades = trades.where(F.to_date("ts").isin(days))
    if trades.isEmpty():
        log.warning("no trades match at %s", trades_path)
        return None
    if fill and seed_close is not None:
        from ..operators.bars import fill_bars, with_bucket
        from ..schema import BAR_COLUMNS_WITH_BUCKET

        filled = fill_bars(trades, parse_timeframe(timeframe), unique_ids=unique_ids, seed_close=seed_close)
        return with_bucket(filled).select(*BAR_COLUMNS_WITH_BUCKET)
    return compute_bars(trades, parse_timeframe(timeframe), fill=fill, unique_ids=unique_ids)


def bars_job(
    spark: SparkSession,
    trades_path: str,
    output_root: str,
    timeframe,
    fill: bool = True,
    fmt: str = "parquet",
    mode: str = "overwrite",
    symbols=None,
    start_date=None,
    end_date=None,
    num_partitions: int | None = None,
    max_records: int | None = None,
    unique_ids: bool = False,
    seed_from_stored: bool = True,
    run: int | None = None,
) -> str | None:
    """Stored trades -> bars table at ``{output_root}/{duration label}``.

    ``start_date`` and ``end_date`` pick trades by file date.  Bars belong to the
    days of the trades' own times, which may differ, so the run recomputes the days
    that the picked trades touch, no others, from all trades of those days: only
    complete days are overwritten.  Which days those are, and which file dates hold
    them, comes from the table's zone map, so that the scan opens those partitions only.
    With stored bars of the same duration, the fill of each run of days starts from the
    last close stored before it.

    With ``mode="append"`` and the number of the ``run``, bars are added beside those of earlier
    runs, and ``load_bars`` reads the latest run of each (symbol, bucket).

    ``unique_ids=True`` uses the hash-aggregate open/close, which needs
    (symbol, ts, id) to be unique; the default is exact for any data.
    """
    from ..sinks.tables import bars_path

    days = dates = seed = None
    if start_date or end_date:
        try:
            days, dates = touched(update_zones(spark, trades_path, fmt), symbols, start_date, end_date)
        except AnalysisException as exc:
            if _missing(exc):
                log.warning("nothing stored at %s", trades_path)
                return None
            raise
        if not days:
            log.warning("no trades match at %s", trades_path)
            return None
        if fill and seed_from_stored:
            seed = seed_from_bars(spark, bars_path(output_root, timeframe), days, symbols, fmt)
    bars = bars_frame(spark, trades_path, timeframe, fill, fmt, symbols, days, dates, unique_ids, seed)
    if bars is None:
        return None
    return write_bars(bars, output_root, timeframe, fmt=fmt, mode=mode, num_partitions=num_partitions, max_records=max_records, run=run)


def check_flow(
    spark: SparkSession,
    archives_path: str,
    klines_path: str,
    work_root: str,
    timeframe="1m",
    ratio: float = DEFAULT_CM_RATIO,
    tolerance: float = 1e-5,
) -> dict[str, DataFrame] | None:
    """Whole check flow: zipped trade files -> trades table -> bars table ->
    comparison with exchange klines.  Returns the comparison frames
    (``counts``, ``missing``, ``diffs``, ``nulls``, ``first_diffs``,
    ``verdict``) and ``archives``, the status of each archive, of which broken
    ones give no trades; or ``None`` when there is nothing to compare.

    Each archive is inflated once, for its trades and its status.  Each stage writes its
    table under ``work_root``, which cuts lineage and lets any stage be rerun alone.
    """
    from ..operators.quality import compare_bars
    from ..sources.files import archive_lines, archive_status, archive_trades, read_klines

    ensure_utc(spark)
    trades_root, bars_root = f"{work_root.rstrip('/')}/trades", f"{work_root.rstrip('/')}/bars"
    lines = archive_lines(spark, archives_path)
    raw = archive_trades(lines)
    if raw.isEmpty():
        log.warning("no trade rows in the archives of %s", archives_path)
        return None
    write_trades(prepare_trades(raw, ratio), trades_root)
    out = bars_job(spark, trades_root, bars_root, timeframe)
    if out is None:
        return None
    generated = spark.read.parquet(out)
    frames = compare_bars(generated, read_klines(spark, klines_path), tolerance)
    return frames | {"archives": archive_status(lines)}
