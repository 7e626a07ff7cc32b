"""Time expressions; the session time zone is UTC throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(value: dt.datetime | str | Column) -> Column:
    """A point in time as ``timestamp_ntz``, independent of the driver's local time zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def from_epoch_ms(c: Column) -> Column:
    """Epoch milliseconds to a UTC timestamp, junk as NULL."""
    return F.timestamp_millis(c.try_cast("bigint"))


def from_epoch_s(c: Column) -> Column:
    """Epoch seconds to a UTC timestamp, junk as NULL."""
    return F.timestamp_seconds(c.try_cast("bigint"))


def time_key(ts: Column) -> Column:
    """Key of the time dimension, computable without a lookup: microseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def iso_date(c: Column) -> Column:
    """ISO calendar (extended or compact) and ISO week dates; anything else is NULL."""
    calendar = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c).when(
        c.rlike(r"^\d{8}$"), F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    )
    week_form = r"^(\d{4})-?W(0[1-9]|[1-4]\d|5[0-3])(?:-?([1-7]))?$"
    part = lambda i: F.nullif(F.regexp_extract(c, week_form, i), F.lit("")).try_cast("int")
    jan4 = F.make_date(part(1), F.lit(1), F.lit(4))
    by_week = F.date_add(
        F.date_sub(jan4, F.weekday(jan4)), (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1
    )
    # the two hyphens come together or not at all
    hyphens_agree = c.rlike(r"^\d{4}-W\d{2}(-\d)?$") | c.rlike(r"^\d{4}W\d{2}\d?$")
    return F.coalesce(
        calendar.try_cast("date"),
        F.when(hyphens_agree & (F.weekofyear(by_week) == part(2)), by_week),
    )


def iso_timestamp(c: Column) -> Column:
    """ISO timestamp text (``Z``, offset or naive = UTC) to a UTC timestamp, junk as NULL."""
    return F.when(c.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), c.try_cast("timestamp"))


def minute_bucket(ts: Column, n: int) -> Column:
    """Start of the ``n``-minute bucket *within the hour* (n >= 60 gives the hour)."""
    zero = F.lit(0)
    offset = F.make_dt_interval(zero, zero, F.minute(ts) % F.lit(n), F.lit(0).cast("decimal(18,6)"))
    return F.date_trunc("minute", ts).cast("timestamp_ntz") - offset


def minute_ceiling(ts: Column) -> Column:
    """The whole minute at or after ``ts``."""
    floor = F.date_trunc("minute", ts).cast("timestamp_ntz")
    return F.when(floor == ts.cast("timestamp_ntz"), floor).otherwise(
        floor + F.expr("interval 1 minute")
    )


def calendar_fields(ts: Column) -> list[Column]:
    """Calendar attributes of the time dimension (Sunday = 0, ISO week)."""
    dow = F.dayofweek(ts) - 1
    return [
        F.to_date(ts).alias("date"),
        F.year(ts).cast("smallint").alias("year"),
        F.quarter(ts).cast("smallint").alias("quarter"),
        F.month(ts).cast("smallint").alias("month"),
        F.dayofmonth(ts).cast("smallint").alias("day"),
        F.hour(ts).cast("smallint").alias("hour"),
        F.minute(ts).cast("smallint").alias("minute"),
        dow.cast("smallint").alias("day_of_week"),
        F.weekofyear(ts).cast("smallint").alias("week_of_year"),
        dow.isin(0, 6).alias("is_weekend"),
    ]


def hours_between(first: Column, last: Column) -> Column:
    """Span in hours."""
    return (time_key(last) - time_key(first)) / F.lit(3.6e9)
