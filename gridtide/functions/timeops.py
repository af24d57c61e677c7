"""Time expressions. All assume a session in UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.schemas import ISO_MILLIS, WEATHER_TIME_ZONE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(moment: dt.datetime | Column) -> Column:
    """A literal instant; a time without zone counts as UTC, whatever the driver's own zone."""
    if isinstance(moment, Column):
        return moment
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc))


def parse_utc(text: str | Column, pattern: str = ISO_MILLIS) -> Column:
    """Timestamp from text; text of another form gives NULL instead of an error."""
    return F.try_to_timestamp(_col(text), F.lit(pattern))


def local_to_utc(text: str | Column, time_zone: str = WEATHER_TIME_ZONE) -> Column:
    """UTC instant of a local wall-clock text."""
    return F.to_utc_timestamp(F.try_to_timestamp(_col(text)), time_zone)


def round_to_hour(ts: str | Column) -> Column:
    """Nearest full hour, minute 30 going up."""
    hours = F.round(F.unix_timestamp(_col(ts).cast("timestamp")) / 3600)
    return F.timestamp_seconds((hours * 3600).cast("bigint"))


def calendar_columns(ts: str | Column) -> list[Column]:
    """Hour, weekday (1 = Sunday), month, day of year and ISO week of ``ts``."""
    c = _col(ts)
    return [
        F.hour(c).alias("hour_of_day"),
        F.dayofweek(c).alias("day_of_week"),
        F.month(c).alias("month"),
        F.dayofyear(c).alias("day_of_year"),
        F.weekofyear(c).alias("week_of_year"),
    ]


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Add the calendar columns of ``ts`` in one projection."""
    return df.select("*", *calendar_columns(ts))


def forecast_offset(target: str | Column, vintage: str | Column) -> Column:
    """Whole hours from ``vintage`` to ``target``, rounded down."""
    seconds = F.unix_timestamp(_col(target).cast("timestamp")) - F.unix_timestamp(_col(vintage).cast("timestamp"))
    return F.floor(seconds / 3600)
