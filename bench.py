"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully executed with the ``noop`` sink (whole plan, no driver
collect).  After one warm-up pass, every query runs ``BENCH_RUNS`` times
(default 3) and the median is reported.  Prints one JSON line.

The trade queries also run over ten times the trades (``x10_`` names), written
as several files so that their scans run in parallel; ``bars_1m_struct`` shows
the sort-aggregate open/close beside the hash-aggregate one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickforge.operators import bars as B  # noqa: E402
from tickforge.operators.prepare import prepare_trades  # noqa: E402
from tickforge.operators.quality import verdict  # noqa: E402
from tickforge.plans import catalog as C  # noqa: E402
from tickforge.plans.jobs import bars_job, preprocess  # noqa: E402
from tickforge.session import build_session, remove_shared_dirs, shared_dir  # noqa: E402
from tickforge.sinks.files import land, write_trade_files  # noqa: E402
from tickforge.sources import views as V  # noqa: E402


def ten_times(spark, trades, cpus: int) -> str:
    """Ten copies of the trades, each under symbols of its own, in several files; returns the folder."""
    path = shared_dir(spark, "bench-x10")
    copies = trades.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(9))))
    copies = copies.withColumn("symbol", F.concat("symbol", F.col("_n").cast("string"))).drop("_n")
    copies.repartition(4 * cpus).write.parquet(path)
    return path


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", "tickforge-bench", shuffle_partitions=int(cpus))

    ev = lambda: V.events_trades(spark, sf_dir)
    li = lambda: V.lineitem_trades(spark, sf_dir)
    generated, reference = C._generated_bars(spark, sf_dir), C._stored_rows(spark, C._reference_bars(spark, sf_dir))
    queries = {
        "prepare_trades": lambda: prepare_trades(V.events_raw_trades(spark, sf_dir)),
        "bars_1h": lambda: B.aggregate_bars(ev(), "1h", unique_ids=True),
        "bars_1m": lambda: B.aggregate_bars(ev(), "1m", unique_ids=True),
        "bars_1m_struct": lambda: B.aggregate_bars(ev(), "1m"),
        "bars_filled_1h": lambda: B.fill_bars(ev(), "1h", unique_ids=True),
        "bars_filled_1m": lambda: B.fill_bars(ev(), "1m", unique_ids=True),
        "bars_ties_1d": lambda: B.aggregate_bars(li(), "24h"),
        "bars_filled_ties_1m": lambda: B.fill_bars(li(), "1m"),
        "bars_multi": lambda: B.bars_for_durations(ev(), ["1m30s", "5m", "1h"], unique_ids=True),
        "trade_count_report": lambda: C.q_trade_count_report(spark, sf_dir),
        # The two bars tables are written beforehand, as the check finds them.
        "check_verdict": lambda: verdict(generated, reference),
        "check_verdict_equal": lambda: verdict(generated, generated),
        "timeframe_parse": lambda: C.q_timeframe_parse(spark, sf_dir),
    }
    many = spark.read.parquet(ten_times(spark, ev(), int(cpus)))
    queries |= {
        "x10_bars_1m": lambda: B.aggregate_bars(many, "1m", unique_ids=True),
        "x10_bars_1m_struct": lambda: B.aggregate_bars(many, "1m"),
        "x10_bars_filled_1m": lambda: B.fill_bars(many, "1m", unique_ids=True),
        "x10_bars_multi": lambda: B.bars_for_durations(many, ["1m30s", "5m", "1h"], unique_ids=True),
    }

    def run(fn):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for fn in queries.values():  # warm-up: JIT, file listing caches
        run(fn)
    timings = {}
    for name, fn in queries.items():
        timings[name] = round(statistics.median(run(fn) for _ in range(runs)), 3)

    # Whole jobs on files: raw daily CSVs -> trades table (L1), trades table -> 1-minute bars table (L2).
    raw_root = shared_dir(spark, "bench-raw")
    land(write_trade_files(V.events_trades(spark, sf_dir).withColumn("time", F.unix_millis(F.col("ts").cast("timestamp"))), raw_root))
    n_trades = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    def job(fn):
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    jobs = {
        "job_preprocess": lambda: preprocess(spark, raw_root, shared_dir(spark, "bench-trades"), num_partitions=int(cpus)),
    }
    trades_root = shared_dir(spark, "bench-trades-fixed")
    preprocess(spark, raw_root, trades_root, num_partitions=int(cpus))
    jobs["job_bars_1m"] = lambda: bars_job(spark, trades_root, shared_dir(spark, "bench-bars"), "1m")
    for fn in jobs.values():
        job(fn)
    for name, fn in jobs.items():
        timings[name] = round(statistics.median(job(fn) for _ in range(runs)), 3)

    headline = [k for k in timings if not k.endswith("_struct")]
    total = round(sum(timings[k] for k in headline), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum of median seconds over headline queries",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
        "trades": n_trades,
        "trades_per_sec": {k: round(n_trades / timings[k]) for k in ("job_preprocess", "job_bars_1m", "bars_1m", "bars_filled_1m")},
    }))
    remove_shared_dirs(spark)
    spark.stop()


if __name__ == "__main__":
    main()
