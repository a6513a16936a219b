"""Time conversion and 10-minute grid arithmetic on ``TIMESTAMP_NTZ``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.model import BIN


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n), F.lit(0))


def epoch_to_ts(seconds: Column) -> Column:
    """Unix seconds (double) to a UTC timestamp; NaN, infinity and NULL give NULL."""
    micros = F.round(seconds * 1_000_000.0).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def floor_to(ts: Column, width: str) -> Column:
    """Start of the clock-aligned window of ``width`` that holds ``ts``.

    At most one of these per ``select`` (a Spark rule for time windows).
    """
    return F.window(ts, width)["start"]


def floor_to_bin(ts: Column) -> Column:
    return floor_to(ts, BIN)


def interval_seconds(interval: Column) -> Column:
    """Length of a day-time interval in seconds, as a double."""
    return interval.cast("interval second").cast("decimal(18,6)").cast("double")


def ntz_to_instant(ts: Column) -> Column:
    """UTC ``TIMESTAMP_NTZ`` to the instant it names, whatever the session time zone."""
    seconds = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return F.timestamp_micros((seconds.cast("decimal(18,6)") * 1_000_000).cast("bigint"))


def instant_to_ntz(instant: Column) -> Column:
    """An instant as UTC ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
