import datetime as dt

from tickforge.operators.report import chart_series, trade_count_matrix, trade_count_report, trade_count_totals, trade_counts


def counts(spark):
    rows = [("BTCUSDT", dt.date(2024, 1, 1))] * 1200 + [("BTCUSDT", dt.date(2024, 1, 2))] * 3 + [("ETHUSDT", dt.date(2024, 1, 2))] * 5
    return trade_counts(spark.createDataFrame(rows, "symbol string, date date"))


def test_matrix_with_totals(spark):
    m = {r["symbol"]: r.asDict() for r in trade_count_matrix(counts(spark)).collect()}
    assert m["ETHUSDT"]["2024-01-01"] == 0 and m["ETHUSDT"]["Total"] == 5
    assert m["Total"]["2024-01-02"] == 8 and m["Total"]["Total"] == 1208
    long = {(r["symbol"], r["day"]): r["trade_count"] for r in trade_count_totals(counts(spark)).collect()}
    assert long[("BTCUSDT", "Total")] == 1203 and ("ETHUSDT", "2024-01-01") not in long


def test_report_text(spark):
    lines = [r["line"] for r in trade_count_report(counts(spark)).orderBy("section", "symbol").collect()]
    title, rule, header, _, btc, eth, _, total, _ = lines
    assert title.strip() == "Asset Metrics - Trade Count per Symbol / Day"
    assert header == "   symbol  2024-01-01  2024-01-02  Total"
    assert btc == "  BTCUSDT       1,200           3  1,203"
    assert eth == "  ETHUSDT           0           5      5"
    assert total == "    Total       1,200           8  1,208"
    assert rule == "-" * len(header)


def test_chart_series(spark):
    bars = spark.createDataFrame(
        [("BTCUSDT", dt.datetime(2024, 1, 1, h), 1.0 + h, 2.0, 0.5, 1.5, 10.0, 1.2, dt.date(2024, 1, 1)) for h in (2, 1, 0)]
        + [("ETHUSDT", dt.datetime(2024, 1, 2, 0), 1.0, 2.0, 0.5, 1.5, 10.0, 1.2, dt.date(2024, 1, 2))],
        "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double, vwap double, bucket date",
    )
    rows = chart_series(bars, ["BTCUSDT", "ETHUSDT"], "1_hour", "2024-01-01").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["open"] == [1.0, 2.0, 3.0] and r["open_time"][0] == "2024-01-01 00:00:00.000000"
    assert r["title"] == "BTCUSDT OHLC - 1_hour Bars (2024-01-01)" and r["file_stem"] == "btcusdt_ohlc_2024-01-01"
    assert r["axis_symbol"] == "BTC"
