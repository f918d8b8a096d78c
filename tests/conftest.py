import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tickforge.session import ensure_utc, remove_shared_dirs  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tickforge-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_utc(s)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickforge-ckpt-"))
    yield s
    remove_shared_dirs(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tickforge-test-")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


TRADE_DDL = "symbol string, id long, price double, qty double, quote_qty double, is_buyer_maker boolean, ts timestamp_ntz"


def trades_df(spark, rows):
    """rows: (symbol, id, price, qty, quote_qty, is_buyer_maker, ts-text)."""
    data = [(r[0], r[1], r[2], r[3], r[4], r[5], ts(r[6]) if isinstance(r[6], str) else r[6]) for r in rows]
    return spark.createDataFrame(data, TRADE_DDL)
