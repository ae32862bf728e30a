"""Date and time functions. The reference time is always an argument, so a plan gives the same rows when it is rerun."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The date formats accepted on input, and the widths of the metric intervals.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
INTERVALS = {"HOURLY": "HOUR", "DAILY": "DAY", "WEEKLY": "WEEK"}


PYTHON_DATE_FORMATS = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ"]


def as_utc(value: datetime) -> datetime:
    """The same moment as a naive UTC time; a naive time is UTC already."""
    return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value


def parsed_date(text: str | None) -> datetime | None:
    """A configured date in one of the accepted formats as UTC time, else null."""
    for form in PYTHON_DATE_FORMATS if text else ():
        try:
            return datetime.strptime(text, form)
        except ValueError:
            continue
    return None


def moment(value: datetime, like: T.DataType) -> Column:
    """A time literal of the column's own type, so that the comparison still reaches the Parquet scan."""
    text = as_utc(value).isoformat(sep=" ", timespec="microseconds")
    return F.lit(text).cast("timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp")


def parse_date(text: Column) -> Column:
    """UTC time in one of the three accepted formats, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def format_ms_z(ts: Column) -> Column:
    """ISO text with milliseconds, cut off and not rounded."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def cutoff(as_of: datetime, days: int) -> datetime:
    return as_of - timedelta(days=days)


def day_label(day: Column) -> Column:
    return F.date_format(day, "MMM dd")


def span_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def created_on(created_at: Column, day: date | str) -> Column:
    """Prefix test on ISO text."""
    return created_at.startswith(day if isinstance(day, str) else day.isoformat())


def latency_ms(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000


def is_uuid7(ident: Column) -> Column:
    return F.coalesce(ident.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"), F.lit(False))


def uuid7_time(ident: Column) -> Column:
    """Creation time held in the first 48 bits of a version-7 UUID."""
    millis = F.conv(F.substring(F.replace(ident, F.lit("-"), F.lit("")), 1, 12), 16, 10).cast("long")
    return F.when(is_uuid7(ident), F.timestamp_millis(millis))


def bucket(ts: Column, interval: str) -> Column:
    """Start of the interval a time falls in; ``TOTAL`` puts everything into one (null) bucket."""
    if interval == "TOTAL":
        return F.lit(None).cast("timestamp")
    return F.date_trunc(INTERVALS[interval], ts)


def yesterday(as_of: datetime) -> tuple[datetime, datetime]:
    """First and last microsecond of the UTC day before ``as_of``."""
    as_of = as_utc(as_of)
    start = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=1)
    return start, start + timedelta(days=1) - timedelta(microseconds=1)


def lookback(as_of: datetime, days: int) -> tuple[datetime, datetime]:
    return as_of - timedelta(days=days), as_of
