"""Date and time expressions.

Every helper that needs "now" takes ``as_of``, which makes results reproducible. Without it the
current time is an expression, not a value read when the plan is built: a batch query sees one time
throughout, and each micro-batch of a stream sees its own.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

Moment = str | dt.date | dt.datetime

MONTH_ID = "yyyyMM"

# Output formats by granularity name.
DATE_FORMATS = {"DAY": "yyyy-MM-dd", "MONTH": "yyyyMM", "YEAR": "yyyy"}

DATE_PARTS = ("day_of_month", "month", "year", "day_of_week", "hour_of_day")


def as_datetime(moment: Moment | None) -> dt.datetime:
    """A moment as naive UTC datetime: ISO text, a month (``yyyyMM``, ``yyyy-MM``), or ``None`` for now."""
    if moment is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(moment, str):
        month = re.fullmatch(r"(\d{4})-?(\d{2})", moment)
        moment = dt.datetime.fromisoformat(f"{month[1]}-{month[2]}-01" if month else moment)
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return moment
    return dt.datetime(moment.year, moment.month, moment.day)


def month_bounds(moment: Moment) -> tuple[dt.datetime, dt.datetime]:
    """First instant of the month of ``moment`` and of the month after it."""
    day = as_datetime(moment)
    start = dt.datetime(day.year, day.month, 1)
    return start, (start + dt.timedelta(days=32)).replace(day=1)


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column, found without regard to letter case."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise KeyError(f"no column {name!r} in {df.columns}")


def instant(moment: Moment | None, data_type: T.DataType | None = None) -> Column:
    """Literal of the same type as the column it is compared with.

    A literal of another time type makes Spark cast the *column*, and a cast column is not pushed
    down to the file scan. ``None`` is the time the query (or micro-batch) runs.
    """
    if moment is None:
        if isinstance(data_type, T.TimestampNTZType):
            return F.localtimestamp()
        return F.current_date() if isinstance(data_type, T.DateType) else F.current_timestamp()
    text = as_datetime(moment).isoformat(sep=" ")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(data_type, T.DateType):
        return F.lit(text).cast("timestamp").cast("date")
    return F.lit(text).cast("timestamp")


def month_start(ts: Column | str) -> Column:
    return F.trunc(ts, "month")


def month_id(ts: Column | str) -> Column:
    """Partition id ``yyyyMM``."""
    return F.date_format(ts, MONTH_ID)


def reformat_date(date: Column | str, granularity: str) -> Column:
    """DAY, MONTH or YEAR text of a date (or of ISO date text)."""
    if granularity not in DATE_FORMATS:
        raise ValueError(f"unknown granularity {granularity!r}; use one of {sorted(DATE_FORMATS)}")
    return F.date_format(date, DATE_FORMATS[granularity])


def date_parts(ts: Column | str) -> dict[str, Column]:
    """Five calendar columns; the week starts with Sunday = 1."""
    parts = (F.dayofmonth(ts), F.month(ts), F.year(ts), F.dayofweek(ts), F.hour(ts))
    return dict(zip(DATE_PARTS, parts))


def whole_minutes(start: Column | str, end: Column | str) -> Column:
    """Completed minutes from start to end (162 seconds are 2 minutes)."""
    return F.timestamp_diff("MINUTE", start, end)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def months_before(as_of: Moment | None, months: int, data_type: T.DataType | None = None) -> Column:
    """``as_of`` minus whole months, typed like the column it is compared with."""
    return instant(as_of, data_type) - F.expr(f"INTERVAL {int(months)} MONTH")


def stamp_text(ts: Column | str) -> Column:
    """Timestamp as text, the form messages carry it in."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def date_from_text(text: Column | str, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")
