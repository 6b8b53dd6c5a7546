"""Timestamp column expressions (DAT-1..5).

All times are ``TIMESTAMP_NTZ`` (the reference has no zone anywhere).  The
helpers below use only zone-free field extractors, so results do not depend
on ``spark.sql.session.timeZone`` (``date_format`` on an NTZ value goes
through the session zone and shifts wall-clock times inside DST gaps).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventsieve.functions.text import col_of


DATE_TIME = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?\s*$"


def parse_timestamp(c: str | Column) -> Column:
    """Text to ``TIMESTAMP_NTZ``; unparsable or blank text gives null.

    Accepted forms, for every step that parses dates: ``yyyy-MM-dd`` and
    ``yyyy-MM-dd HH:mm[:ss[.f to .fffffffff]]`` with a space or ``T``
    between, spaces around.  No bare years or months, no zones or offsets
    (a cast alone takes them and drops the offset).
    """
    text = col_of(c).cast("string")
    return F.when(text.rlike(DATE_TIME), text.try_cast("timestamp_ntz"))


def as_timestamp(c: str | Column) -> Column:
    """Pass timestamps through, parse anything else."""
    return parse_timestamp(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def format_millis(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` with the fraction truncated; null -> ``''``."""
    ts = col_of(c)
    millis = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("int") % 1000
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d.%03d",
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts), millis,
    )
    return F.coalesce(F.when(ts.isNotNull(), text), F.lit(""))


def format_seconds(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (used by the driver-table adapter).

    Years of four digits are the first 19 characters of the value's text; the
    formatter, which takes other years and nulls, is many times slower."""
    ts = col_of(c)
    formatted = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d",
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts),
    )
    return F.when(F.year(ts).between(1, 9999), F.substring(ts.cast("string"), 1, 19)).otherwise(formatted)


def add_seconds(c: str | Column, seconds: str | Column) -> Column:
    return col_of(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col_of(seconds).cast("decimal(18,6)"))


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of an NTZ value, from date and
    clock fields only (``timestamp_diff``/``unix_micros`` would first convert
    the NTZ value to a session-zone TIMESTAMP and shift across DST)."""
    ts = col_of(c)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    micros_of_day = (
        F.hour(ts).cast("long") * 3_600_000_000
        + F.minute(ts).cast("long") * 60_000_000
        + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    )
    return days * 86_400_000_000 + micros_of_day


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated toward zero)."""
    diff = epoch_micros(end) - epoch_micros(start)
    return (diff / 1_000_000).cast("long")


def hour_or_missing(c: str | Column) -> Column:
    return F.coalesce(F.hour(col_of(c)), F.lit(-1))


def weekday_or_missing(c: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6; null -> -1."""
    return F.coalesce(F.weekday(col_of(c)), F.lit(-1))


def epoch_seconds(c: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ value (zone-free)."""
    return F.floor(epoch_micros(c) / 1_000_000)
