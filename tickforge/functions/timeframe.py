"""Bar durations.

A duration is written as hours, minutes and seconds in that order, each part
optional: ``30s``, ``5m``, ``1h30m``.  Accepted durations lie between one
second and one day and divide the day; anything longer than a day is taken as
one day.  The canonical label spells the duration out (``1 hour 30 minutes``)
and names the output directory once blanks become underscores.

Two forms share these rules: ``parse_timeframe`` for a literal argument on the
driver, and ``parse_timeframes`` for a column of a table of bar specs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted grammar, day length and label words.
DURATION_PATTERN = r"^(?:(\d+)h)?(?:(\d+)m)?(?:(\d+)s)?$"
DAY_SECONDS = 86400
ONE_DAY_LABEL = "1 day"
UNIT_WORDS = (("hour", 3600), ("minute", 60), ("second", 1))

ERR_NOT_TEXT = "duration must be text such as '60s' or '1m30s'"
ERR_FORMAT = "invalid duration format; use e.g. '30s', '5m', '2h' or '1m30s'"
ERR_TOO_SHORT = "duration must be at least 1 second"
ERR_NOT_DIVISOR = "duration must divide 24 hours (86400 seconds)"

_COMPILED = re.compile(DURATION_PATTERN)


@dataclass(frozen=True)
class Timeframe:
    seconds: int
    label: str

    @property
    def micros(self) -> int:
        return self.seconds * 1_000_000

    @property
    def directory(self) -> str:
        """Output folder, named by the length alone: ``24h`` and ``25h`` are both one day."""
        return (ONE_DAY_LABEL if self.seconds == DAY_SECONDS else _label(self.seconds)).replace(" ", "_")


def _label(total: int) -> str:
    if total > DAY_SECONDS:
        return ONE_DAY_LABEL
    # Largest unit shown is the first one the total reaches.
    units = [u for u in UNIT_WORDS if total >= u[1]]
    parts = []
    rest = total
    for word, size in units:
        n, rest = divmod(rest, size)
        if n > 0:
            parts.append(f"{n} {word}{'s' if n > 1 else ''}")
    return " ".join(parts)


def valid_durations() -> list[int]:
    """Every accepted length in seconds (the divisors of a day)."""
    return [s for s in range(1, DAY_SECONDS + 1) if DAY_SECONDS % s == 0]


def parse_timeframe(text) -> Timeframe:
    """Parse a duration literal; raises ``ValueError`` on rejected input."""
    if isinstance(text, Timeframe):
        return text
    if not isinstance(text, str):
        raise ValueError(ERR_NOT_TEXT)
    match = _COMPILED.match(text.strip().lower())
    if not match:
        raise ValueError(f"{ERR_FORMAT}: {text!r}")
    h, m, s = (int(g or 0) for g in match.groups())
    total = h * 3600 + m * 60 + s
    if total < 1:
        raise ValueError(ERR_TOO_SHORT)
    if total > DAY_SECONDS:
        return Timeframe(DAY_SECONDS, ONE_DAY_LABEL)
    if DAY_SECONDS % total != 0:
        raise ValueError(f"{ERR_NOT_DIVISOR}: {text!r} is {total} seconds")
    return Timeframe(total, _label(total))


def _part(text: Column, idx: int) -> Column:
    digits = F.regexp_replace(F.regexp_extract(text, DURATION_PATTERN, idx), "^0+", "")
    # More than 12 significant digits is far beyond a day: clamp instead of overflowing.
    return (
        F.when(digits == "", F.lit(0).cast("decimal(38,0)"))
        .when(F.length(digits) > 12, F.lit(10**12).cast("decimal(38,0)"))
        .otherwise(digits.cast("decimal(38,0)"))
    )


def _label_col(total: Column) -> Column:
    def word(n: Column, unit: str) -> Column:
        return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {unit}"), F.when(n > 1, F.lit("s")).otherwise(F.lit(""))))

    h = F.floor(total / 3600)
    m_all = F.floor(total / 60)
    hm = F.concat_ws(
        " ",
        word(h, "hour"),
        word(F.floor((total % 3600) / 60), "minute"),
        word(total % 60, "second"),
    )
    ms = F.concat_ws(" ", word(m_all, "minute"), word(total % 60, "second"))
    return (
        F.when(total >= 3600, hm)
        .when(total >= 60, ms)
        .otherwise(word(total, "second"))
    )


def _norm(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def _total(norm: Column) -> Column:
    return _part(norm, 1) * 3600 + _part(norm, 2) * 60 + _part(norm, 3)


def _result(text: Column, ok: Column, total: Column) -> Column:
    error = (
        F.when(text.isNull(), F.lit(ERR_NOT_TEXT))
        .when(~ok, F.lit(ERR_FORMAT))
        .when(total < 1, F.lit(ERR_TOO_SHORT))
        .when(total > DAY_SECONDS, F.lit(None).cast("string"))
        .when(F.lit(DAY_SECONDS) % total != 0, F.lit(ERR_NOT_DIVISOR))
    )
    seconds = F.when(error.isNull(), F.least(total, F.lit(DAY_SECONDS)).cast("int"))
    label = F.when(
        error.isNull(),
        F.when(total > DAY_SECONDS, F.lit(ONE_DAY_LABEL)).otherwise(_label_col(F.least(total, F.lit(DAY_SECONDS)).cast("long"))),
    )
    return F.struct(seconds.alias("seconds"), label.alias("label"), error.alias("error"))


def parse_timeframes(df, text_col: str, out: str = "tf"):
    """Adds ``out`` = struct(seconds, label, error) for a table of duration texts.

    Each distinct text is parsed once (a partial-aggregated ``distinct``), in
    staged projections that keep generated methods small, and the results are
    attached with a null-safe equi-join.  The parsed side has one row per
    distinct text; AQE broadcasts it only after measuring it.
    """
    texts = df.select(F.col(text_col).alias("_tf_text")).distinct()
    staged = texts.withColumn("_tf_norm", _norm(F.col("_tf_text")))
    staged = staged.withColumn("_tf_ok", F.col("_tf_norm").rlike(DURATION_PATTERN)).withColumn("_tf_total", _total(F.col("_tf_norm")))
    parsed = staged.select("_tf_text", _result(F.col("_tf_text"), F.col("_tf_ok"), F.col("_tf_total")).alias(out))
    joined = df.join(parsed, df[text_col].eqNullSafe(parsed["_tf_text"]), "left")
    return joined.drop("_tf_text")
