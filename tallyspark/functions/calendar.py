"""Dates and times."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_day(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_length(day: Column) -> Column:
    """Number of days in the month of ``day``."""
    return F.dayofmonth(F.last_day(day))


def in_month_to_date(column: str, as_of: date | str | Column) -> Column:
    """First of the month up to ``as_of``, both ends included.

    A literal ``as_of`` is folded to two constants, so the test reaches the scan.
    """
    day = as_day(as_of)
    return F.col(column).between(month_start(day), day)


def moment_of_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp; zero and null mean "not known"."""
    return F.timestamp_millis(F.nullif(ms, F.lit(0)))


def utc_clock(moment: Column) -> Column:
    """What a UTC clock shows at that moment, as a timestamp without a zone.

    The session time zone has no part in it, so neither have its gaps and repeated hours.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment.cast("timestamp")), epoch)


def utc_day(moment: Column) -> Column:
    """The UTC date of a moment, whatever the session time zone is."""
    return utc_clock(moment).cast("date")


def utc_midnight(day: Column) -> Column:
    """The moment at which a day begins in UTC."""
    return F.timestamp_seconds(F.unix_date(day).cast("long") * 86400)


def iso_moment(moment: Column) -> Column:
    """``2026-08-12T10:00:00+00:00``, in UTC; fractions of a second only when there are any."""
    seconds = F.replace(F.substring_index(utc_clock(moment).cast("string"), ".", 1), F.lit(" "), F.lit("T"))
    micros = F.pmod(F.unix_micros(moment.cast("timestamp")), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(seconds, fraction, F.lit("+00:00"))
