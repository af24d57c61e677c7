"""Time-range filters: lookback windows, observed/forecast split, horizon."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.timeops import instant
from gridtide.schemas import DAY


def _hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def lookback(df: DataFrame, ts_col: str, hours: int, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (default: now).

    The column stands bare on the left of a constant, so the filter reaches the
    Parquet scan; days before it are not read if ``df`` has the partition column.
    """
    end = F.current_timestamp() if as_of is None else instant(as_of)
    return from_time(df, end - _hours(hours), ts_col)


def anchored_lookback(
    df: DataFrame, ts_col: str, hours: int, anchor_df: DataFrame | None = None, extra_hours: int = 0
) -> DataFrame:
    """Rows of the last ``hours`` (plus ``extra_hours``) before an anchor found in the data.

    ``anchor_df`` has one row and one column; by default it is the latest full
    hour of ``ts_col``. The bound enters as a scalar subquery: no join, no collect,
    and once known it is pushed into the scan.
    """
    if anchor_df is None:
        anchor_df = df.agg(F.max(F.date_trunc("hour", ts_col)))
    bound = anchor_df.toDF("anchor").select(F.col("anchor") - _hours(hours + extra_hours)).scalar()
    return df.filter(F.col(ts_col) >= bound)


def from_time(df: DataFrame, bound: Column, ts_col: str = "datetime") -> DataFrame:
    """Rows at or after ``bound``; days before it are not read if ``df`` has the partition column."""
    kept = df.filter(F.col(ts_col) >= bound)
    return kept.filter(F.col(DAY) >= F.to_date(bound)) if DAY in df.columns else kept


def at_time(df: DataFrame, moment: Column, ts_col: str = "datetime") -> DataFrame:
    """Rows at ``moment``, read from its day alone if ``df`` has the partition column."""
    kept = df.filter(F.col(ts_col) == moment)
    return kept.filter(F.col(DAY) == F.to_date(moment)) if DAY in df.columns else kept


def split_observed_forecast(df: DataFrame, dt_col: str, vintage_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows at or before their vintage, rows after it)."""
    return (
        df.filter(F.col(dt_col) <= F.col(vintage_col)),
        df.filter(F.col(dt_col) > F.col(vintage_col)),
    )


def horizon(df: DataFrame, hours: int = 24, offset_col: str = "forecast_offset_h") -> DataFrame:
    """Rows whose forecast offset lies in 1 … ``hours``."""
    return df.filter((F.col(offset_col) > 0) & (F.col(offset_col) <= hours))
