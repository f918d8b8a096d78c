import datetime as dt

from tickforge.operators.quality import compare_bars, missing_rows, schema_mismatch, value_diffs, verdict, with_bar_index

DDL = ("symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double, "
       "quote_volume double, count long, taker_buy_volume double, taker_buy_quote_volume double")


def bar(sym, hour, close, **kw):
    base = dict(open=1.0, high=2.0, low=0.5, close=close, volume=10.0, quote_volume=20.0, count=3,
                taker_buy_volume=4.0, taker_buy_quote_volume=8.0)
    base.update(kw)
    return (sym, dt.datetime(2024, 1, 1, hour), base["open"], base["high"], base["low"], base["close"], base["volume"],
            base["quote_volume"], base["count"], base["taker_buy_volume"], base["taker_buy_quote_volume"])


def test_compare_tolerance_missing_and_nulls(spark):
    gen = spark.createDataFrame([bar("A", 0, 1.0), bar("A", 1, 1.000001), bar("A", 2, 1.0001), bar("A", 3, 1.0),
                                 bar("A", 5, 1.0, volume=None)], DDL)
    ref = spark.createDataFrame([bar("A", 0, 1.0), bar("A", 1, 1.0), bar("A", 2, 1.0), bar("A", 4, 1.0),
                                 bar("A", 5, 1.0), bar("B", 0, 1.0)], DDL)
    res = compare_bars(gen, ref)
    diffs = [(r["open_time"].hour, r["column"]) for r in res["diffs"].collect()]
    assert diffs == [(2, "close")]  # 1e-6 is within tolerance, 1e-4 is not
    missing = sorted((r["missing_in"], r["symbol"], r["open_time"].hour) for r in res["missing"].collect())
    assert missing == [("generated", "A", 4), ("generated", "B", 0), ("reference", "A", 3)]
    nulls = [(r["open_time"].hour, r["column"]) for r in res["nulls"].collect()]
    assert nulls == [(5, "volume")]
    v = {r["symbol"]: r for r in res["verdict"].collect()}
    assert v["A"]["status"] == 1 and v["A"]["differing_cells"] == 1 and v["A"]["missing_in_reference"] == 1
    assert v["B"]["rows_generated"] == 0 and v["B"]["status"] == 1
    ok = compare_bars(gen, gen)["verdict"].collect()
    assert all(r["status"] == 0 and r["equal"] for r in ok)
    assert schema_mismatch(gen, ref) == []


def test_positional_alignment_and_index(spark):
    gen = spark.createDataFrame([bar("A", h, float(h)) for h in range(3)], DDL)
    ref = spark.createDataFrame([bar("A", h + 10, float(h)) for h in range(3)], DDL)  # no common times
    assert compare_bars(gen, ref, align="position")["verdict"].first()["status"] == 0
    assert compare_bars(gen, ref)["verdict"].first()["status"] == 1
    idx = sorted((r["open_time"].hour, r["idx"]) for r in with_bar_index(gen).collect())
    assert idx == [(0, 0), (1, 1), (2, 2)]


def test_first_diffs_limit(spark):
    gen = spark.createDataFrame([bar("A", h, 1.0) for h in range(15)], DDL)
    ref = spark.createDataFrame([bar("A", h, 2.0) for h in range(15)], DDL)
    top = compare_bars(gen, ref)["first_diffs"].collect()
    assert len(top) == 10 and max(r["rank"] for r in top) == 10


def test_verdict_fails_null_cells_duplicates_and_missing_columns(spark):
    whole = spark.createDataFrame([bar("A", 0, 1.0)], DDL)
    nulls = spark.createDataFrame([bar("A", 0, None, open=None)], DDL)
    v = verdict(nulls, whole).first()
    assert (v["null_cells"], v["differing_cells"], v["equal"], v["exact"], v["status"]) == (2, 0, False, False, 1)
    v = verdict(whole.unionByName(whole), whole).first()
    assert (v["rows_generated"], v["rows_reference"], v["missing_in_reference"], v["status"]) == (2, 1, 1, 1)
    v = verdict(whole.unionByName(whole), whole.unionByName(whole)).first()
    assert v["equal"] and v["exact"]
    close = spark.createDataFrame([bar("A", 0, 1.00001)], DDL)
    v = verdict(close, whole).first()
    assert v["equal"] == (v["differing_cells"] == 0) and not v["exact"]
    v = verdict(whole.drop("volume"), whole).first()
    assert not v["same_schema"] and v["status"] == 1
    assert schema_mismatch(whole.drop("volume"), whole) == ["volume: missing in generated"]


def test_digests_agree_only_on_equal_rows(spark):
    """Days with odd values are never settled by their digests; nulls in other places differ."""
    day = [bar("A", h, float(h)) for h in range(4)]
    for change in (bar("A", 2, float("nan")), bar("A", 2, float("inf")), bar("A", 2, None), bar("A", 2, 2.0, volume=None)):
        rows = spark.createDataFrame([*day[:2], change, day[3]], DDL)
        v = verdict(rows, spark.createDataFrame(day, DDL)).first()
        assert v["status"] == 1 and v["differing_cells"] + v["null_cells"] == 1
    odd = spark.createDataFrame([*day[:2], bar("A", 2, float("nan")), day[3]], DDL)
    assert verdict(odd, odd).first()["status"] == 1  # NaN equals nothing
    a, b = (spark.createDataFrame([bar("A", 1, 1.0, **{c: None})], DDL) for c in ("volume", "quote_volume"))
    assert verdict(a, b).first()["null_cells"] == 2
    none = (None, *day[0][1:])
    v = {r["symbol"]: r for r in verdict(spark.createDataFrame([none, *day], DDL), spark.createDataFrame([none, *day[::-1]], DDL)).collect()}
    assert v["A"]["exact"] and (v[None]["missing_in_generated"], v[None]["missing_in_reference"]) == (1, 1)
    twice = spark.createDataFrame([*day, day[0]], DDL)
    assert verdict(twice, spark.createDataFrame(day, DDL)).first()["missing_in_reference"] == 1


def test_days_that_agree_are_not_aligned(spark, monkeypatch):
    from tickforge.operators import quality as Q

    later = lambda r, days: (r[0], r[1] + dt.timedelta(days=days), *r[2:])
    rows = [later(bar("A", h, 1.0), d) for d in range(5) for h in range(3)]
    other = [r if r[1].day != 3 else (*r[:5], 9.0, *r[6:]) for r in rows]
    alike, joined, _ = Q._differing(spark.createDataFrame(rows, DDL), spark.createDataFrame(other, DDL), "time")
    assert alike.count() == 4 and joined.select("open_time").distinct().count() == 3
    assert {r["open_time"].day for r in joined.collect()} == {3}
    v = verdict(spark.createDataFrame(rows, DDL), spark.createDataFrame(other, DDL)).first()
    assert (v["rows_generated"], v["rows_reference"], v["differing_cells"]) == (15, 15, 3)


def test_comparison_joins_rows_once(spark):
    from test_plans import executed

    a = spark.createDataFrame([bar("A", h, 1.0) for h in range(3)], DDL)
    b = spark.createDataFrame([bar("A", h, 1.0) for h in range(1, 4)], DDL)
    for frame in (missing_rows(a, b), verdict(a, b), value_diffs(a, b)):
        plan = executed(frame).split("== Initial Plan ==")[0]
        assert plan.count("FullOuter") == 1 and plan.count("Join") - plan.count("LeftSemi") == 1
