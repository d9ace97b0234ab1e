"""Instants, ages and their text forms, as Column functions."""

from datetime import datetime

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3.6e9


def instant(value) -> Column:
    """A timestamp Column from a Column, a datetime or ISO text.

    A datetime without a zone is taken in the session zone, never in the zone of the Python process.
    """
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def parse_created_at(text: Column) -> Column:
    """Parse ``Tue Oct 31 22:10:47 +0000 2017``; anything else is NULL.

    The weekday is skipped, since the rest names the day already and the current parser refuses it.
    """
    return F.try_to_timestamp(F.substr(text, F.lit(5)), F.lit("MMM d HH:mm:ss Z yyyy"))


def parse_event_text(text: Column) -> Column:
    """Parse ISO text, or ``yyyy-MM-dd HH:mm:ss.f`` text which must carry a fraction."""
    return F.when(text.contains("T"), F.try_to_timestamp(text)).otherwise(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))


def _micros(ts):
    """Microseconds from the epoch; a time without zone counts as UTC, whatever the session zone."""
    zoneless = F.try_to_timestamp(F.concat(ts.cast("string"), F.lit("+00:00")))
    return F.unix_micros(F.when(F.typeof(ts) == "timestamp_ntz", zoneless).otherwise(ts.cast("timestamp")))


def _utc_text(ts, fraction):
    """Date and time in UTC, whatever the session zone: counted from the epoch without a zone."""
    micros = _micros(ts)
    seconds = F.floor(micros / F.lit(1000000)) if not fraction else micros / F.lit(1000000).cast("decimal(20,0)")
    text = (F.expr("timestamp_ntz'1970-01-01 00:00:00'")
            + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")
    return F.replace(text, F.lit(" "), F.lit("T"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text to the second, ending in ``Z``."""
    return F.concat(_utc_text(ts, False), F.lit("Z"))


def iso_offset(ts: Column) -> Column:
    """ISO-8601 text in UTC with its offset; a fraction has six digits and is left out when it is zero."""
    text = _utc_text(ts, True)
    return F.concat(
        F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text), F.lit("+00:00"))


def to_millis(ts: Column) -> Column:
    return F.date_trunc("millisecond", ts)


def event_month(ts: Column) -> Column:
    """First day of the month: the partition column of the interaction table."""
    return F.trunc(ts, "month")


def hours_ago(ts: Column, as_of) -> Column:
    """Hours from ``ts`` to ``as_of``; 0.0 when missing, negative when in the future."""
    gap = F.unix_micros(instant(as_of)) - F.unix_micros(ts.cast("timestamp"))
    return F.coalesce(gap / F.lit(MICROS_PER_HOUR), F.lit(0.0))


def hours_ago_text(text: Column, as_of) -> Column:
    return hours_ago(parse_event_text(text), as_of)
