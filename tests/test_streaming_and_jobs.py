import datetime as dt

from pyspark.sql import functions as F

from tickforge.operators import bars as B
from tickforge.operators.report import chart_series
from tickforge.plans import catalog
from tickforge.plans.jobs import bars_frame, bars_job, seed_from_bars
from tickforge.sinks.files import write_chart_series
from tickforge.sinks.tables import write_trades
from tickforge.sinks.zones import read_zones, touched, update_zones
from tickforge.sources.views import events_trades
from tickforge.streaming.bars import current_bars, stream_bars, upsert_bars

SF = "/root/testdata/sf0.001"


def test_stream_bars_match_batch(spark, tmp_dir):
    t = events_trades(spark, SF)
    t.repartition(3, F.xxhash64("id")).write.parquet(f"{tmp_dir}/in")  # files in no order of time, one per batch
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    q = upsert_bars(stream_bars(stream, "1h", watermark="31 days"), f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    assert q.exception() is None
    assert spark.read.parquet(f"{tmp_dir}/out").select("batch_id").distinct().count() >= 3
    got = current_bars(spark, f"{tmp_dir}/out").drop("volume", "vwap", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")
    want = B.aggregate_bars(t, "1h").select(*got.columns)
    got = got.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_time") else F.col(c) for c in got.columns])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_query_counts_trades_of_any_span(spark, tmp_dir):
    events = spark.read.parquet(f"{SF}/events.parquet")
    wide = events.withColumn("ts", F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 5 * 100).cast("int")))
    wide.write.parquet(f"{tmp_dir}/events.parquet")
    got = catalog.q_stream_bars_1h(spark, tmp_dir).select("symbol", F.col("open_time").cast("timestamp_ntz").alias("open_time"), "count")
    want = B.aggregate_bars(events_trades(spark, tmp_dir), "1h").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bars_job_seeds_close_from_stored_bars(spark, tmp_dir):
    t = spark.createDataFrame(
        [("A", 1, 10.0, 1.0, 10.0, False, dt.datetime(2024, 1, 1, 12), dt.date(2024, 1, 1)),
         ("A", 2, 20.0, 1.0, 20.0, False, dt.datetime(2024, 1, 3, 12), dt.date(2024, 1, 3))],
        "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp_ntz, date date",
    )
    write_trades(t, f"{tmp_dir}/trades")
    out = bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "6h")
    assert spark.read.parquet(out).count() == 8
    # Rerun from 2024-01-03 only: the first slot takes the stored close of 2024-01-01.
    bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "6h", start_date="2024-01-03")
    day3 = {r["open_time"].hour: r for r in spark.read.parquet(out).where(F.col("bucket") == "2024-01-03").collect()}
    assert day3[0]["close"] == 10.0 and day3[12]["close"] == 20.0
    assert spark.read.parquet(out).count() == 8  # dynamic overwrite replaced the day, no duplicates
    from tickforge.sources.trades import load_bars

    assert load_bars(spark, f"{tmp_dir}/bars", "6h", symbols=["A"], start="2024-01-03").count() == 4


def test_rerun_by_file_date_keeps_trades_of_the_day_before(spark, tmp_dir):
    row = lambda i, ts, day: ("A", i, 10.0 + i, 1.0, 10.0, False, ts, day)
    last_ms = dt.datetime(2024, 1, 1, 23, 59, 59, 999_000)
    t = spark.createDataFrame(
        [row(1, dt.datetime(2024, 1, 1, 9), dt.date(2024, 1, 1)), row(2, dt.datetime(2024, 1, 1, 23), dt.date(2024, 1, 1)),
         row(3, last_ms, dt.date(2024, 1, 2)), row(4, dt.datetime(2024, 1, 2, 1), dt.date(2024, 1, 2))],
        "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp_ntz, date date",
    )
    write_trades(t, f"{tmp_dir}/trades")
    out = bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "12h")
    full = sorted(spark.read.parquet(out).collect())
    bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "12h", start_date="2024-01-02")
    assert sorted(spark.read.parquet(out).collect()) == full
    assert sum(r["count"] for r in full) == 4


def _trade(i, ts, day, symbol="A"):
    return (symbol, i, 10.0 + i, 1.0, 10.0, False, ts, day)


TRADES = "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp_ntz, date date"


def test_rerun_of_two_far_days_touches_no_other(spark, tmp_dir):
    rows = [_trade(d, dt.datetime(2024, 1, d, 9), dt.date(2024, 1, d), s) for d in range(1, 21) for s in "AB" if (s, d) != ("B", 9)]
    rows += [_trade(30, dt.datetime(2024, 1, 4, 23), dt.date(2024, 1, 5))]  # filed a day late
    write_trades(spark.createDataFrame(rows, TRADES), f"{tmp_dir}/trades")
    out = bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "6h")
    full = sorted(spark.read.parquet(out).collect())
    files = {r[0]: r[1] for r in spark.read.parquet(out).select("bucket", F.col("_metadata.file_path")).distinct().collect()}
    days, dates = touched(update_zones(spark, f"{tmp_dir}/trades"), None, "2024-01-05", "2024-01-05")
    assert days == [dt.date(2024, 1, 4), dt.date(2024, 1, 5)] and dates == days
    zones = read_zones(spark, f"{tmp_dir}/trades")
    both = zones.where(F.col("date").isin([dt.date(2024, 1, 5), dt.date(2024, 1, 10)]))
    assert touched(both)[0] == [dt.date(2024, 1, 4), dt.date(2024, 1, 5), dt.date(2024, 1, 10)]
    # Days that are far apart: each run of days takes the close stored before it.
    bars = bars_frame(spark, f"{tmp_dir}/trades", "6h", days=[dt.date(2024, 1, 4), dt.date(2024, 1, 10)], file_dates=[dt.date(2024, 1, d) for d in (4, 5, 10)],
                      seed_close=seed_from_bars(spark, out, [dt.date(2024, 1, 4), dt.date(2024, 1, 10)]))
    want = [r for r in full if r["bucket"].day in (4, 10)]
    assert sorted(map(str, bars.select(*spark.read.parquet(out).columns).withColumn("open_time", F.col("open_time")).collect())) == sorted(map(str, want))
    bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "6h", start_date="2024-01-05", end_date="2024-01-05")
    assert sorted(spark.read.parquet(out).collect()) == full
    now = {r[0]: r[1] for r in spark.read.parquet(out).select("bucket", F.col("_metadata.file_path")).distinct().collect()}
    assert {d for d in files if files[d] != now[d]} <= {dt.date(2024, 1, 4), dt.date(2024, 1, 5)}


def test_rerun_scan_is_pruned(spark, tmp_dir):
    rows = [_trade(d, dt.datetime(2024, 1, d, 9), dt.date(2024, 1, d)) for d in range(1, 10)]
    write_trades(spark.createDataFrame(rows, TRADES), f"{tmp_dir}/trades")
    days, dates = touched(update_zones(spark, f"{tmp_dir}/trades"), None, "2024-01-08", None)
    bars = bars_frame(spark, f"{tmp_dir}/trades", "6h", days=days, file_dates=dates)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in plan and bars.select("bucket").distinct().count() == 2


def test_zone_map_follows_the_table(spark, tmp_dir):
    path = f"{tmp_dir}/trades"
    row = lambda d, hour: _trade(d, dt.datetime(2024, 1, d, hour), dt.date(2024, 1, d))
    write_trades(spark.createDataFrame([row(1, 1), row(2, 2)], TRADES), path)
    assert update_zones(spark, path).count() == 2
    write_trades(spark.createDataFrame([row(2, 5)], TRADES), path, mode="append")
    write_trades(spark.createDataFrame([row(3, 7)], TRADES), path)
    got = {r["day"].day: (r["trades"], r["first_ts"].hour, r["last_ts"].hour) for r in update_zones(spark, path).collect()}
    assert got == {1: (1, 1, 1), 2: (2, 2, 5), 3: (1, 7, 7)}
    write_trades(spark.createDataFrame([row(2, 6)], TRADES), path)  # replaces the partition
    assert {r["day"].day: r["trades"] for r in update_zones(spark, path).collect()} == {1: 1, 2: 1, 3: 1}
    assert spark.read.parquet(path).count() == 3  # readers pass over the map


def test_jobs_keep_the_price_order_of_equal_ids(spark, tmp_dir):
    ts = dt.datetime(2024, 1, 1, 9)
    t = spark.createDataFrame(
        [("A", 1, p, 1.0, p, False, ts, dt.date(2024, 1, 1)) for p in (5.0, 3.0)],
        "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp_ntz, date date",
    )
    write_trades(t, f"{tmp_dir}/trades")
    r = spark.read.parquet(bars_job(spark, f"{tmp_dir}/trades", f"{tmp_dir}/bars", "24h", fill=False)).first()
    assert (r["open"], r["close"]) == (3.0, 5.0)


def test_chart_sink(spark, tmp_dir):
    bars = B.compute_bars(events_trades(spark, SF), "1h", unique_ids=True)
    series = chart_series(bars, ["VIEWUSDT"], "1_hour", "2024-01-02", "2024-01-03")
    write_chart_series(series, f"{tmp_dir}/charts")
    back = spark.read.json(f"{tmp_dir}/charts")
    assert back.count() == 2 and back.first()["symbol"] == "VIEWUSDT"
