"""Epoch arithmetic on zone-less timestamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.numbers import int_div

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_MINUTE = 60_000_000

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` column."""
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (
        F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * MICROS_PER_DAY
        + F.hour(ts).cast("bigint") * MICROS_PER_HOUR
        + F.minute(ts).cast("bigint") * MICROS_PER_MINUTE
        + (seconds * 1_000_000).cast("bigint")
    )


def from_epoch_micros(micros: Column) -> Column:
    """The ``timestamp_ntz`` that lies ``micros`` after 1970-01-01."""
    rest = F.pmod(micros, F.lit(MICROS_PER_DAY))
    days = int_div(micros - rest, MICROS_PER_DAY)
    seconds = (rest.cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(
        days.cast("int"), F.lit(0), F.lit(0), seconds
    )


def epoch_minute(ts: Column) -> Column:
    """Whole minutes since 1970-01-01."""
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minute_start(minute: Column) -> Column:
    """The ``timestamp_ntz`` at which an epoch minute starts."""
    rest = F.pmod(minute, F.lit(1440))
    days = int_div(minute - rest, 1440).cast("int")
    return F.expr(_EPOCH) + F.make_dt_interval(days, F.lit(0), rest.cast("int"))
