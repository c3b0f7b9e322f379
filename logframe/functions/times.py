"""Time literals, intervals and epoch arithmetic.

Bounds are parsed in Python and handed to Spark as literals of the column's
own type, so that they reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field, field_type

# Width of each interval unit in seconds (M = 30 d, y = 365 d).
UNIT_SECONDS = {
    "s": 1,
    "m": 60,
    "h": 3600,
    "d": 86400,
    "w": 604800,
    "M": 2592000,
    "y": 31536000,
}

EPOCH = dt.datetime(1970, 1, 1)


def parse_time(value: str | dt.datetime | dt.date) -> dt.datetime:
    """A naive UTC datetime from ISO text, a date or a datetime; without a zone it is UTC."""
    if isinstance(value, str):
        try:
            value = dt.datetime.fromisoformat(value)
        except ValueError as error:
            raise ValueError(
                f"unreadable timestamp {value!r}: use ISO 8601 such as 2024-01-31T12:00:00Z"
            ) from error
    elif not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def parse_window(from_ts, to_ts) -> tuple[dt.datetime | None, dt.datetime | None]:
    """Both bounds parsed; empty bounds are open and a reversed range is an error."""
    start = parse_time(from_ts) if from_ts else None
    end = parse_time(to_ts) if to_ts else None
    if start is not None and end is not None and start > end:
        raise ValueError(f"reversed time range: {from_ts} is after {to_ts}")
    return start, end


def parse_interval(interval: str) -> int:
    """Seconds in an interval such as ``15m``."""
    match = re.fullmatch(r"([0-9]+)([smhdwMy])", interval)
    if not match or int(match[1]) == 0:
        raise ValueError(
            f"bad interval {interval!r}: a positive number and one unit of s m h d w M y, or 'auto'"
        )
    return int(match[1]) * UNIT_SECONDS[match[2]]


def seconds_since_epoch(moment: dt.datetime) -> int:
    """Whole seconds since 1970, rounded down."""
    return (moment - EPOCH) // dt.timedelta(seconds=1)


def time_column(df: DataFrame, ts_field: str) -> tuple[Column, T.DataType]:
    """The time field and its type; ISO text and dates are read as timestamps."""
    dtype = field_type(df, ts_field)
    column = field(df, ts_field)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return column, dtype
    if isinstance(dtype, T.DateType):
        return column.cast("timestamp_ntz"), T.TimestampNTZType()
    if isinstance(dtype, T.StringType):
        # The cast without a zone drops one, so texts with an offset are read as
        # instants, and these taken as UTC without the session's zone.
        utc = column.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+)?Z?$")
        offset = column.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.]+ ?[+-][0-9]{2}:?[0-9]{2}$")
        zoned = F.regexp_replace(column, r" ?([+-][0-9]{2}):?([0-9]{2})$", "$1:$2")
        moved = F.timestamp_add(
            "MICROSECOND",
            F.unix_micros(zoned.try_cast("timestamp")),
            time_literal(T.TimestampNTZType(), EPOCH),
        )
        read = F.when(utc, column.try_cast("timestamp_ntz")).when(offset, moved)
        return read, T.TimestampNTZType()
    raise ValueError(f"field {ts_field!r} of type {dtype.simpleString()} is not a time field")


def time_literal(dtype: T.DataType, moment: dt.datetime) -> Column:
    """``moment`` as a literal of a timestamp column's type."""
    text = moment.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(column: Column, dtype: T.DataType) -> Column:
    """Whole seconds since 1970, rounded down also before 1970."""
    # unix_timestamp drops the fraction towards zero, so shift early instants first.
    early = F.unix_timestamp(column - F.expr("interval '0.999999' second"))
    return F.when(column < time_literal(dtype, EPOCH), early).otherwise(F.unix_timestamp(column))


def from_epoch_seconds(seconds: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(seconds)
    return F.timestamp_add("SECOND", seconds, time_literal(dtype, EPOCH))


def bucket_start(seconds: Column, width: Column | int) -> Column:
    """Largest multiple of ``width`` not after ``seconds``."""
    width = F.lit(width) if isinstance(width, int) else width
    return seconds - F.pmod(seconds, width.cast("bigint"))


def utc_day(column: Column, dtype: T.DataType) -> Column:
    """The UTC date of a timestamp, whatever the session's time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return column.cast("date")
    day = F.floor(epoch_seconds(column, dtype) / UNIT_SECONDS["d"])
    return F.date_from_unix_date(day.cast("int"))
