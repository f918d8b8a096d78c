import pytest

from tickforge.functions.timeframe import parse_timeframe, parse_timeframes, valid_durations


@pytest.mark.parametrize(
    "text,seconds,label",
    [
        ("1m", 60, "1 minute"),
        ("90s", 90, "1 minute 30 seconds"),
        ("1h30m", 5400, "1 hour 30 minutes"),
        ("24h", 86400, "24 hours"),
        ("25h", 86400, "1 day"),
        (" 2H ", 7200, "2 hours"),
        ("1s", 1, "1 second"),
        ("1h0m1s", 3601, None),
    ],
)
def test_parse_accepts(text, seconds, label):
    if label is None:
        with pytest.raises(ValueError):
            parse_timeframe(text)
        return
    tf = parse_timeframe(text)
    assert (tf.seconds, tf.label) == (seconds, label)


@pytest.mark.parametrize("text", ["7m", "1h 30m", "", "1d", "0s", "abc", "5m1h", None, 60])
def test_parse_rejects(text):
    with pytest.raises(ValueError):
        parse_timeframe(text)


def test_directory_name():
    assert parse_timeframe("1h30m").directory == "1_hour_30_minutes"


def test_valid_durations_include_ones_missing_from_short_lists():
    v = valid_durations()
    assert 9 in v and 18 in v and 86400 in v and 7 not in v


def test_column_form_agrees_with_literal_form(spark):
    texts = ["1m", "90s", "1h30m", "24h", "25h", " 2H ", "7m", "1h 30m", "", "1d", "0s", "0h0m0s",
             "00001m", "99999999999999999999h", "59s", "3m20s", "12h", "1h1s", "45m", None]
    texts += [f"{h}h{m}m{s}s" for h in range(0, 3) for m in (0, 15, 59) for s in (0, 30)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: (r["tf"]["seconds"], r["tf"]["label"], r["tf"]["error"] is not None)
           for r in parse_timeframes(df, "text").collect()}
    for t in texts:
        try:
            tf = parse_timeframe(t)
            want = (tf.seconds, tf.label, False)
        except ValueError:
            want = (None, None, True)
        assert got[t] == want, t
