"""Print the executed physical plans of the headline operators (markdown).

    python tools/show_plans.py > PLANS.md

Each plan is taken after running the DataFrame's own query, so AQE's final
plan (reused exchanges, runtime join choices) is shown.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickforge.operators import bars as B  # noqa: E402
from tickforge.operators.prepare import prepare_trades  # noqa: E402
from tickforge.operators.quality import missing_rows, verdict  # noqa: E402
from tickforge.operators.report import trade_count_report, trade_counts  # noqa: E402
from tickforge.plans import catalog as C  # noqa: E402
from tickforge.session import build_session, remove_shared_dirs  # noqa: E402
from tickforge.sinks.tables import write_trades  # noqa: E402
from tickforge.sources import views as V  # noqa: E402
from tickforge.sources.trades import load_trades  # noqa: E402

SF = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0].rstrip()
    return re.sub(r"#\d+L?", "", text)  # expression ids add noise


def main():
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    ev = V.events_trades(spark, SF)
    tmp = tempfile.mkdtemp(prefix="tickforge-plans-")
    write_trades(prepare_trades(V.events_raw_trades(spark, SF)), tmp)
    items = {
        "aggregate_bars(1h, unique_ids=True)": B.aggregate_bars(ev, "1h", unique_ids=True),
        "aggregate_bars(24h) - exact struct order": B.aggregate_bars(V.lineitem_trades(spark, SF), "24h"),
        "fill_bars(1h, unique_ids=True)": B.fill_bars(ev, "1h", unique_ids=True),
        "forward_fill_close(1h): the fill cut to one column": B.forward_fill_close(ev, "1h", unique_ids=True),
        "load_trades(symbols, date range) on the partitioned table": load_trades(
            spark, tmp, symbols=["VIEWUSDT"], start_date="2024-01-10", end_date="2024-01-12"
        ),
        "verdict(filled 1h vs reference 1h)": verdict(C._generated_bars(spark, SF), C._reference_bars(spark, SF)),
        "missing_rows(filled 1h vs reference 1h)": missing_rows(C._generated_bars(spark, SF), C._reference_bars(spark, SF)),
        "trade_count_report (from the counts written once)": trade_count_report(trade_counts(ev)),
    }
    print("# Physical plans (AQE final plans at sf0.01, expression ids removed)\n")
    print("Generated by `python tools/show_plans.py`.\n")
    for name, df in items.items():
        print(f"## {name}\n\n```\n{final_plan(df)}\n```\n")
    remove_shared_dirs(spark)
    spark.stop()


if __name__ == "__main__":
    main()
