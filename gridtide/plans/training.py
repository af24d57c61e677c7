"""Training rows: each ingestion hour becomes one row per forecast hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.functions import calendar_columns, drop_incomplete, feature_columns
from gridtide.operators import broadcast_if_small, from_time, horizon
from gridtide.plans.gold import SMALL_HOURS, VINTAGE
from gridtide.plans.propagate import Scope
from gridtide.schemas import FORECAST_PREFIXES, HISTORY_PREFIXES, LABEL, TARGET
from gridtide.session import materialize

# Up to this many vintages their arrays (5 kB each) are broadcast.
_SMALL_LISTS = 10_000
TRAINING_KEYS = ["zone", VINTAGE, "datetime"]


def forecast_lists(forecasts: DataFrame, hours: int = 24, columns: list[str] | None = None) -> DataFrame:
    """One row per vintage with its complete forecast rows of offset 1 … ``hours`` as an array.

    (vintage, datetime) is unique and datetimes are hourly, so an array has at
    most ``hours`` elements.
    """
    columns = columns or feature_columns(forecasts, FORECAST_PREFIXES)
    ahead = drop_incomplete(horizon(forecasts, hours))
    entry = F.struct("datetime", "forecast_offset_h", *columns)
    return ahead.groupBy(VINTAGE).agg(F.collect_list(entry).alias("ahead"))


def build_training(
    historic: DataFrame,
    forecasts: DataFrame,
    horizon_hours: int = 24,
    target: str = TARGET,
    lookback_hours: int | None = None,
    group: str = "zone",
    scope: Scope | None = None,
) -> DataFrame:
    """Forecast, calendar, snapshot and target columns per (zone, ingestion hour, forecast hour).

    An ingestion hour *h* of a zone counts if there is exactly one complete
    history row at ``datetime = h`` and every complete forecast row of vintage
    *h* has its target once in that zone's history; else all its rows are left out.
    ``lookback_hours`` keeps the ingestion hours of that many hours before the
    latest one; None takes them all. ``scope`` builds the rows of its zones and ingestion hours
    only; wide rows and targets are then read from the days of these hours.

    Whether an hour counts is decided on narrow rows (keys and target). The wide
    snapshot is shuffled by (zone, hour) before it is expanded, not per forecast
    hour: it is joined with arrays, which are broadcast if a count allows.
    """
    snapshot_cols = feature_columns(historic, HISTORY_PREFIXES)
    forecast_cols = feature_columns(forecasts, FORECAST_PREFIXES)

    hours = historic.select(VINTAGE).filter(F.col(VINTAGE).isNotNull())
    if lookback_hours is not None:
        bound = historic.agg(F.max(VINTAGE) - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))).scalar()
        hours = hours.filter(F.col(VINTAGE) >= bound)
        # Snapshots lie at their ingestion hour, targets after it.
        historic, forecasts = from_time(historic, bound), from_time(forecasts, bound)
    if scope is not None:
        wanted = materialize(scope.hours())
        first, last = (wanted.agg(f(VINTAGE)).scalar() for f in (F.min, F.max))
        # Hours are narrow, and files whose vintages all lie outside these bounds are not read.
        hours = hours.filter((F.col(VINTAGE) >= first) & (F.col(VINTAGE) <= last))
        hours = materialize(hours.join(broadcast_if_small(wanted, SMALL_HOURS), VINTAGE, "left_semi").distinct())
        historic, forecasts = scope.near(historic), scope.near(forecasts)
        forecasts = forecasts.join(broadcast_if_small(hours, SMALL_HOURS), VINTAGE, "left_semi")
    hours = broadcast_if_small(hours.distinct(), SMALL_HOURS)

    lists = broadcast_if_small(forecast_lists(forecasts, horizon_hours, forecast_cols), _SMALL_LISTS)

    at_hour = historic.withColumn(VINTAGE, F.col("datetime"))
    if scope is not None:
        at_hour = scope.pick(at_hour)
    keys = at_hour.select(group, VINTAGE).join(hours, VINTAGE, "left_semi").distinct()
    wanted = keys.join(
        lists.select(VINTAGE, F.explode("ahead.datetime").alias("datetime")), VINTAGE, "inner"
    )
    known = historic.select(group, "datetime", F.col(target).alias(LABEL), F.lit(True).alias("found"))
    targets = (
        wanted.join(known, [group, "datetime"], "left")
        .groupBy(group, VINTAGE)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("found").alias("n_found"),
            F.count_distinct("datetime").alias("n_hours"),
            F.collect_list(F.struct("datetime", LABEL)).alias("targets"),
        )
        .filter("n = n_found AND n = n_hours")
        .select(group, VINTAGE, F.map_from_entries("targets").alias("targets"))
    )
    complete = drop_incomplete(at_hour.select(group, VINTAGE, *snapshot_cols), snapshot_cols)
    snapshots = (
        complete.join(hours, VINTAGE, "left_semi")
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(group, VINTAGE)))
        .filter("n = 1")
        .drop("n")
    )
    expanded = (
        snapshots.join(targets, [group, VINTAGE], "inner")
        .join(lists, VINTAGE, "inner")
        .select("*", F.explode("ahead").alias("f"))
    )
    return expanded.select(
        group,
        VINTAGE,
        "f.datetime",
        *[f"f.{c}" for c in forecast_cols],
        "f.forecast_offset_h",
        *calendar_columns("f.datetime"),
        *snapshot_cols,
        F.col("targets")[F.col("f.datetime")].alias(LABEL),
    )


def split_point(df: DataFrame, ts_col: str = VINTAGE, share: float = 0.8, accuracy: int = 10000) -> Column:
    """Approximate percentile of a timestamp, as a scalar subquery."""
    return df.agg(F.percentile_approx(ts_col, share, accuracy)).scalar()


def mark_split(df: DataFrame, ts_col: str = VINTAGE, share: float = 0.8, accuracy: int = 10000) -> DataFrame:
    """Add ``is_train``: at or before the split point. Whole vintages stay together."""
    return df.withColumn("is_train", F.col(ts_col) <= split_point(df, ts_col, share, accuracy))


def chrono_split(
    df: DataFrame, ts_col: str = VINTAGE, share: float = 0.8, accuracy: int = 10000
) -> tuple[DataFrame, DataFrame]:
    """(train, test) cut at one point in time.

    The point is computed once, as one value: two approximate runs might differ,
    and then a vintage could be in both parts or in none.
    """
    micros = df.agg(F.unix_micros(F.percentile_approx(ts_col, share, accuracy))).head()[0]
    at = F.timestamp_micros(F.lit(micros))
    return df.filter(F.col(ts_col) <= at), df.filter(F.col(ts_col) > at)
