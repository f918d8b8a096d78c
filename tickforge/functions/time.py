"""Time arithmetic on epoch microseconds.

Bars are keyed by integer epoch microseconds so that any duration, including
one read from a column, buckets with plain long arithmetic inside codegen.
Timestamps are converted back only on bar-sized data.  The session time zone
is UTC (see ``tickforge.session``), which makes TIMESTAMP and TIMESTAMP_NTZ
map to the same microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column, ntz: bool = True) -> Column:
    t = F.timestamp_micros(us)
    return t.cast("timestamp_ntz") if ntz else t


def floor_micros(us: Column, step_us) -> Column:
    """Start of the ``step_us`` bucket holding ``us`` (aligned to the epoch)."""
    step = step_us if isinstance(step_us, Column) else F.lit(int(step_us))
    return us - F.pmod(us, step)


def ts_from_millis(ms: Column) -> Column:
    """Exact event time from epoch milliseconds."""
    return F.timestamp_millis(ms)


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)
