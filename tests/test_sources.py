import json
import os
import zipfile

from pyspark.sql import functions as F

from tickforge.operators.manifest import file_manifest, kline_manifest, landed_files, manifest_document, manifest_urls, missing_files, missing_summary
from tickforge.operators.prepare import prepare_trades
from tickforge.sources.files import archive_lines, archive_status, ingest_archives, list_files, read_klines, read_manifest, write_manifest


def test_archive_ingest_with_corrupt_zip(spark, tmp_dir):
    with zipfile.ZipFile(f"{tmp_dir}/BTCUSDT-trades-2024-01-01.zip", "w") as zf:
        zf.writestr("BTCUSDT-trades-2024-01-01.csv", "id,price,qty,quote_qty,time,is_buyer_maker\n1,10.0,2,20,1704067200000,false\n2,11.0,1,11,1704067201000,true\n")
    with open(f"{tmp_dir}/ETHUSDT-trades-2024-01-01.zip", "wb") as fh:
        fh.write(b"not a zip")
    with open(f"{tmp_dir}/readme.gz", "wb") as fh:
        fh.write(b"ignored")
    lines = archive_lines(spark, tmp_dir)
    status = {os.path.basename(r["archive"]): r for r in archive_status(lines).collect()}
    assert status["BTCUSDT-trades-2024-01-01.zip"]["ok"] and status["BTCUSDT-trades-2024-01-01.zip"]["lines"] == 3
    assert not status["ETHUSDT-trades-2024-01-01.zip"]["ok"]
    assert len(status) == 2
    out = prepare_trades(ingest_archives(spark, tmp_dir)).collect()
    assert sorted((r["id"], r["symbol"], str(r["date"])) for r in out) == [(1, "BTCUSDT", "2024-01-01"), (2, "BTCUSDT", "2024-01-01")]


def test_manifest_document_roundtrip_skips_entries_without_url(spark, tmp_dir):
    doc = {"market": "um", "start": "2024-01-01", "end": "2024-01-02",
           "entries": [{"date": "2024-01-01", "symbol": "BTCUSDT", "url": "http://x/BTCUSDT-trades-2024-01-01.zip"},
                       {"date": "2024-01-02", "symbol": "BTCUSDT"}]}
    with open(f"{tmp_dir}/m.json", "w") as fh:
        json.dump(doc, fh, indent=4)
    urls = manifest_urls(read_manifest(spark, f"{tmp_dir}/m.json")).collect()
    assert [r["url"] for r in urls] == ["http://x/BTCUSDT-trades-2024-01-01.zip"]


def test_file_manifest_and_reconciliation(spark, tmp_dir):
    bases = spark.createDataFrame([("BTCUSD",), ("ETHUSD",)], "symbol string")
    m = file_manifest(bases, "2024-01-01", "2024-01-03", market="um", root="http://h")
    rows = sorted((r["date"], r["symbol"]) for r in m.collect())
    assert len(rows) == 6 and rows[0] == ("2024-01-01", "BTCUSDT")
    assert m.where(F.col("symbol") == "BTCUSDT").first()["url"].startswith("http://h/um/daily/trades/BTCUSDT/BTCUSDT-trades-")
    cm = file_manifest(bases, "2024-01-01", "2024-01-05", market="cm", day_step=2)
    assert sorted({r["symbol"] for r in cm.collect()}) == ["BTCUSD_PERP", "ETHUSD_PERP"] and cm.count() == 6
    path = f"{tmp_dir}/doc"
    write_manifest(manifest_document(m, "2024-01-01", "2024-01-03"), path)
    assert manifest_urls(read_manifest(spark, path)).count() == 6
    for name in ["BTCUSDT-trades-2024-01-01.zip", "BTCUSDT-trades-2024-01-02.zip", "ETHUSDT-trades-2024-01-01.csv", "nodate.zip"]:
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write("x")  # Spark's file scan skips zero-length files
    landed = landed_files(list_files(spark, tmp_dir, "*-trades-*"))
    miss = sorted((r["symbol"], r["date"]) for r in missing_files(m, landed).collect())
    assert miss == [("BTCUSDT", "2024-01-03"), ("ETHUSDT", "2024-01-02"), ("ETHUSDT", "2024-01-03")]
    s = missing_summary(m, landed).first()
    assert (s["expected"], s["landed"], s["missing"]) == (6, 3, 3)


def test_kline_manifest_symbols(spark):
    landed = spark.createDataFrame([("BTCUSDT-trades-2024-01-01.zip", "BTCUSDT", "2024-01-01"),
                                    ("BTCUSD_PERP-trades-2024-01-01.zip", "BTCUSD_PERP", "2024-01-01"),
                                    ("ETHBUSD-trades-2024-01-01.zip", "ETHBUSD", "2024-01-01")], "file string, symbol string, date string")
    out = {r["symbol"]: r for r in kline_manifest(landed, "1m", root="http://h").collect()}
    assert set(out) == {"BTCUSDT", "BTCUSD_PERP", "ETHBUSDUSD_PERP"}
    assert out["BTCUSD_PERP"]["market"] == "cm"
    assert out["BTCUSDT"]["url"] == "http://h/um/daily/klines/BTCUSDT/1m/BTCUSDT-1m-2024-01-01.zip"


def test_read_klines_by_header_name(spark, tmp_dir):
    with open(f"{tmp_dir}/BTCUSDT-1m-2024-01-01.csv", "w") as fh:
        fh.write("close,open_time,open,high,low,volume,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,extra\n"
                 "2.5,1704067200000,1.0,3.0,0.5,10,20,7,4,8,x\n")
    r = read_klines(spark, tmp_dir).first()
    assert r["symbol"] == "BTCUSDT" and r["close"] == 2.5 and r["count"] == 7
    assert r["open_time"].isoformat().startswith("2024-01-01T00:00")


def test_table_sink_layout_options(spark, tmp_dir):
    from tickforge.sinks.tables import write_trades

    df = spark.createDataFrame(
        [("A", i, 1.0, 1.0, 1.0, False, None, __import__("datetime").date(2024, 1, 1 + i % 2)) for i in range(20)],
        "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp, date date",
    )
    write_trades(df, f"{tmp_dir}/t", num_partitions=2, max_records=3)
    files = [f for f in os.listdir(f"{tmp_dir}/t/symbol=A/date=2024-01-01") if f.endswith(".parquet")]
    assert len(files) >= 4  # 10 rows, at most 3 per file
    write_trades(df, f"{tmp_dir}/h", num_partitions=2, layout="hash")
    assert spark.read.parquet(f"{tmp_dir}/h").count() == 20


def test_csv_file_writer_names_and_no_temp_left(spark, tmp_dir):
    from tickforge.sinks.files import write_trade_files

    df = spark.createDataFrame(
        [("A", __import__("datetime").date(2024, 1, 1), 1, 1.0, 1.0, 1.0, 1704067200000, True)],
        "symbol string, date date, id long, price double, qty double, quote_qty double, time long, is_buyer_maker boolean",
    )
    written = write_trade_files(df, tmp_dir).collect()
    assert [r["rows"] for r in written] == [1]
    names = os.listdir(tmp_dir)
    assert len(names) == 1 and names[0].startswith("A-trades-2024-01-01-p") and names[0].endswith(".csv")
    with open(f"{tmp_dir}/{names[0]}") as fh:
        assert fh.read() == "id,price,qty,quote_qty,time,is_buyer_maker\n1,1.0,1.0,1.0,1704067200000,true\n"


def test_broken_archives_give_no_rows(spark, tmp_dir):
    """A checksum error and a cut-off file far into an archive: nothing of them is ingested."""
    text = "id,price,qty,quote_qty,time,is_buyer_maker\n" + "".join(f"{i},10.{i},2,20,{1704067200000 + i},false\n" for i in range(5000))
    with zipfile.ZipFile(f"{tmp_dir}/GOODUSDT-trades-2024-01-01.zip", "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("GOODUSDT-trades-2024-01-01.csv", text)
    raw = bytearray(open(f"{tmp_dir}/GOODUSDT-trades-2024-01-01.zip", "rb").read())
    open(f"{tmp_dir}/CUTUSDT-trades-2024-01-01.zip", "wb").write(raw[: len(raw) // 2])
    raw[100_000] ^= 1
    open(f"{tmp_dir}/CRCUSDT-trades-2024-01-01.zip", "wb").write(raw)
    lines = archive_lines(spark, tmp_dir, chunk_bytes=10_000)
    status = {os.path.basename(r["archive"])[:3]: (r["ok"], r["lines"]) for r in archive_status(lines).collect()}
    assert status == {"GOO": (True, 5001), "CUT": (False, 0), "CRC": (False, 0)}
    out = ingest_archives(spark, tmp_dir)
    assert out.count() == 5000 and out.agg(F.sum("id")).first()[0] == sum(range(5000))


def test_malformed_lines_are_dropped_alike_from_files_and_archives(spark, tmp_dir):
    from tickforge.sources.trades import read_trades

    text = "id,price,qty,quote_qty,time,is_buyer_maker\n1,1.0,1,1,1704067200000,false\n2,1.0,1,1,1704067200000,false,9\n3,x,1,1,1704067200000,true\n"
    os.mkdir(f"{tmp_dir}/csv"), os.mkdir(f"{tmp_dir}/zip")
    open(f"{tmp_dir}/csv/A-trades-2024-01-01.csv", "w").write(text)
    with zipfile.ZipFile(f"{tmp_dir}/zip/A-trades-2024-01-01.zip", "w") as zf:
        zf.writestr("A-trades-2024-01-01.csv", text)
    assert [r["id"] for r in read_trades(spark, f"{tmp_dir}/csv").collect()] == [1]
    assert [r["id"] for r in ingest_archives(spark, f"{tmp_dir}/zip").collect()] == [1]


def test_klines_by_each_file_header(spark, tmp_dir):
    import pytest

    head = ["open_time", "open", "high", "low", "close", "volume", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume"]
    row = ["1704067200000", "8", "12", "7", "10", "1", "2", "3", "4", "5"]
    swap = [1, 0, 3, 2, 4, 5, 6, 7, 8, 9]
    for name, order in (("A", range(10)), ("B", swap)):
        with open(f"{tmp_dir}/{name}USDT-1h-2024-01-01.csv", "w") as fh:
            fh.write(",".join(head[i] for i in order) + "\n" + ",".join(row[i] for i in order) + "\n")
    got = {(r["open"], r["high"], r["low"], r["close"], r["count"]) for r in read_klines(spark, tmp_dir).collect()}
    assert got == {(8.0, 12.0, 7.0, 10.0, 3)}
    with open(f"{tmp_dir}/CUSDT-1h-2024-01-01.csv", "w") as fh:
        fh.write(",".join(head[:-1]) + "\n" + ",".join(row[:-1]) + "\n")
    with pytest.raises(Exception, match="no column taker_buy_quote_volume"):
        read_klines(spark, tmp_dir).collect()


def test_written_files_do_not_follow_the_number_of_tasks(spark, tmp_dir):
    from tickforge.sinks.files import land, write_trade_files

    day = __import__("datetime").date(2024, 1, 1)
    rows = [("A" if i % 2 else "B", day, i, 1.0, 1.0, 1.0, None if i == 3 else 1704067200000, True) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, date date, id long, price double, qty double, quote_qty double, time long, is_buyer_maker boolean")
    for n in (1, 4):
        land(write_trade_files(df.repartition(n), f"{tmp_dir}/{n}"))
        assert len([f for f in os.listdir(f"{tmp_dir}/{n}") if f.endswith(".csv")]) == 2
    from tickforge.sources.trades import read_trades

    back = {r["id"]: r["time"] for r in read_trades(spark, f"{tmp_dir}/4").collect()}
    assert len(back) == 40 and back[3] is None and back[4] == 1704067200000


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest

    from tickforge import session

    class Bare:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = property(lambda self: self)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Bare(), "x")
    path = session.shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.remove_shared_dirs(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:"))


def test_archives_are_inflated_once(spark, tmp_dir):
    """A member's bytes are read through once for trades and status together: lines come from the stored pass."""
    with zipfile.ZipFile(f"{tmp_dir}/A-trades-2024-01-01.zip", "w") as z:
        z.writestr("A-trades-2024-01-01.csv", "id,price\n1,2\n")
        z.writestr("notes.txt", "not a trade file")
    lines = archive_lines(spark, tmp_dir)
    os.remove(f"{tmp_dir}/A-trades-2024-01-01.zip")  # nothing goes back to the archive
    assert sorted(r["line"] for r in lines.collect()) == ["1,2", "id,price"]
    assert archive_status(lines).first()["ok"]


def test_quarantine_names_each_row_left_out(spark, tmp_dir):
    from tickforge.plans.jobs import preprocess

    head = "id,price,qty,quote_qty,time,is_buyer_maker\n"
    good = "1,2.0,1,2,1704067200000,false\n"
    bad = ["x,2.0,1,2,1704067200000,false", "2,,1,2,1704067200000,false", "3,NaN,1,2,1704067200000,false", "4,0,1,2,1704067200000,true", "5,2,NaN,2,1704067200000,true",
           "6,2,1,2,,true", "7,2,1,2,1704067200000,"]
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/A-trades-2024-01-01.csv", "w") as f:
        f.write(head + good + "\n".join(bad) + "\n")
    with open(f"{tmp_dir}/raw/A-trades.csv", "w") as f:
        f.write(head + good)
    out = preprocess(spark, f"{tmp_dir}/raw", f"{tmp_dir}/trades", quarantine=f"{tmp_dir}/bad")
    assert [r["id"] for r in spark.read.parquet(out).collect()] == [1]
    got = sorted((r["id"] or 0, r["reason"]) for r in spark.read.parquet(f"{tmp_dir}/bad").collect())
    assert got == [(0, "malformed line"), (1, "no date in the file name"), (2, "price is null"), (3, "price is NaN"), (4, "price is not positive"), (5, "qty is NaN"),
                   (6, "time is null"), (7, "is_buyer_maker is null")]
    preprocess(spark, f"{tmp_dir}/raw", f"{tmp_dir}/plain")
    assert spark.read.parquet(f"{tmp_dir}/plain").exceptAll(spark.read.parquet(out)).count() == 0


def test_a_clean_run_empties_the_quarantine(spark, tmp_dir):
    from tickforge.plans.jobs import preprocess

    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/A-trades-2024-01-01.csv", "w") as f:
        f.write("id,price,qty,quote_qty,time,is_buyer_maker\n1,2.0,1,2,1704067200000,false\n")
    preprocess(spark, f"{tmp_dir}/raw", f"{tmp_dir}/trades", quarantine=f"{tmp_dir}/bad")
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == 0


def test_ledger_lists_only_new_files(spark, tmp_dir):
    from tickforge.sources.files import update_listing

    def add(name):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("x")

    os.makedirs(f"{tmp_dir}/in")
    add("A-trades-2024-01-01.zip")
    add("notes.txt")
    assert update_listing(spark, f"{tmp_dir}/in", f"{tmp_dir}/ledger", "*.zip").count() == 1
    parts = set(os.listdir(f"{tmp_dir}/ledger/files"))
    update_listing(spark, f"{tmp_dir}/in", f"{tmp_dir}/ledger", "*.zip")
    add("A-trades-2024-01-02.zip")
    got = update_listing(spark, f"{tmp_dir}/in", f"{tmp_dir}/ledger", "*.zip")
    assert sorted(r["file"] for r in landed_files(got).collect()) == ["A-trades-2024-01-01.zip", "A-trades-2024-01-02.zip"]
    new = [f for f in os.listdir(f"{tmp_dir}/ledger/files") if f not in parts and f.endswith(".parquet")]
    assert spark.read.parquet(*[f"{tmp_dir}/ledger/files/{f}" for f in new]).count() == 1
