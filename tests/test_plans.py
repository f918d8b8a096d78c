"""Plan-shape checks: the properties the design relies on at scale."""

from tickforge.operators import bars as B
from tickforge.operators.prepare import prepare_trades
from tickforge.sinks.tables import write_trades
from tickforge.sources.trades import load_trades, read_trades
from tickforge.sources.views import events_raw_trades, events_trades

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()  # run this DataFrame's own query so AQE finalises its plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_unique_id_bars_use_hash_aggregate(spark):
    plan = executed(B.aggregate_bars(events_trades(spark, SF), "1h", unique_ids=True))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_fill_scans_trades_once(spark):
    plan = executed(B.fill_bars(events_trades(spark, SF), "1h", unique_ids=True))
    assert "ReusedExchange" in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan  # no join in the fill


def test_pruned_fill_scans_trades_once(spark):
    for frame in (B.forward_fill_close(events_trades(spark, SF), "1h", unique_ids=True), B.fill_bars(events_trades(spark, SF), "1h", columns=["volume"])):
        plan = executed(frame).split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and "ReusedExchange" in plan, plan


def test_report_reads_trades_once(spark):
    from tickforge.operators.report import trade_count_report, trade_counts

    plan = executed(trade_count_report(trade_counts(events_trades(spark, SF))))
    assert "events.parquet" not in plan  # only the counts written before


def test_partition_and_data_filters_reach_the_scan(spark, tmp_dir):
    write_trades(prepare_trades(events_raw_trades(spark, SF)), tmp_dir, num_partitions=4)
    df = load_trades(spark, tmp_dir, symbols=["VIEWUSDT"], start_date="2024-01-10", end_date="2024-01-12")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # plan metadata is cut at 100 chars
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [" in plan, plan
    part = plan.split("PartitionFilters: [", 1)[1].split("], ", 1)[0]
    assert "VIEWUSDT" in part and "2024-01-10" in part and "2024-01-12" in part, part
    assert df.select("symbol", "date").distinct().count() == 3


def test_csv_scan_pushes_raw_checks(spark, tmp_dir):
    with open(f"{tmp_dir}/A-trades-2024-01-01.csv", "w") as fh:
        fh.write("id,price,qty,quote_qty,time,is_buyer_maker\n1,1.0,1,1,1704067200000,false\n")
    plan = prepare_trades(read_trades(spark, tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price,0.0)" in plan and "IsNotNull(price)" in plan


def test_seed_reads_only_the_latest_stored_day(spark, tmp_dir):
    from tickforge.operators.bars import compute_bars
    from tickforge.plans.jobs import seed_from_bars
    from tickforge.sinks.tables import write_bars

    path = write_bars(compute_bars(events_trades(spark, SF), "1h", unique_ids=True), tmp_dir, "1h")
    seed = seed_from_bars(spark, path, "2024-01-15")
    assert seed.count() == 5
    seed.collect()
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = seed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    data_scans = [s for s in scans if "ReadSchema: struct<>" not in s]
    assert data_scans and all("dynamicpruning" in s for s in data_scans)  # text may be cut after this
