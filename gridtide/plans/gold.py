"""Feature tables from clean tables: one plan per table, the ingestion hour is part of the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridtide.functions import calendar_features, fill_numeric, forecast_offset, round_to_hour
from gridtide.operators import broadcast_if_small, lag_rolling_features, pivot_measures, split_observed_forecast
from gridtide.schemas import CITIES, DAY, ENERGY_SERIES, MEASURES, sanitize

VINTAGE = "ingested_hour_utc"
HISTORIC_KEYS = ["zone", "datetime"]
FORECAST_KEYS = [VINTAGE, "datetime"]
FEATURE_SCOPES = ("history", "batch")
WINDOW_ROWS = 24
# Up to these sizes a side is broadcast (some 40 MB): pivoted weather rows of 23
# columns, and distinct full hours (a century has 900,000).
_SMALL_WEATHER = 200_000
SMALL_HOURS = 1_000_000


def weather_series(cities=CITIES, measures=MEASURES) -> list[str]:
    """Names of the pivoted weather columns."""
    return [f"{m}_{sanitize(c)}" for c in cities for m in measures]


def with_vintage(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    """``ingested_at`` rounded to the hour as ``ingested_hour_utc``; ``keep_raw`` keeps both."""
    if keep_raw:
        return df.withColumn(VINTAGE, round_to_hour("ingested_at"))
    return df.withColumn("ingested_at", round_to_hour("ingested_at")).withColumnRenamed("ingested_at", VINTAGE)


def vintages(energy: DataFrame) -> DataFrame:
    """Distinct ingestion hours of the energy rows."""
    return energy.select(round_to_hour("ingested_at").alias(VINTAGE)).distinct()


def join_weather(energy: DataFrame, weather: DataFrame, cities=CITIES, measures=MEASURES) -> DataFrame:
    """Observed energy hours with the weather that the same ingestion hour observed for them.

    Weather has no zone, so it is the smaller side by far; if a count allows, it
    is broadcast and the wide energy rows are not shuffled for this join.
    """
    observed, _ = split_observed_forecast(with_vintage(energy), "datetime", VINTAGE)
    seen, _ = split_observed_forecast(with_vintage(weather, keep_raw=True), "datetime", VINTAGE)
    wide = pivot_measures(seen, FORECAST_KEYS, "name", list(cities), list(measures), ["ingested_at"])
    return observed.join(broadcast_if_small(wide, _SMALL_WEATHER), FORECAST_KEYS, "inner")


def feature_keys(energy: DataFrame, weather: DataFrame) -> DataFrame:
    """(zone, datetime) of the rows ``join_weather`` keeps, from narrow columns."""
    hours = with_vintage(energy.select("zone", "datetime", "ingested_at"))
    seen = with_vintage(weather.select("datetime", "ingested_at")).distinct()
    observed, _ = split_observed_forecast(hours, "datetime", VINTAGE)
    return observed.join(seen, FORECAST_KEYS, "left_semi").select("zone", "datetime")


def build_historic(
    energy: DataFrame,
    weather: DataFrame,
    cities=CITIES,
    measures=MEASURES,
    feature_scope: str = "history",
    fill: float | None = 0,
    energy_series=ENERGY_SERIES,
    split_hot: bool = True,
    hot_options: dict | None = None,
) -> DataFrame:
    """Energy with weather, calendar, lag and rolling columns, one row per (zone, datetime).

    ``feature_scope="history"`` runs the windows along each zone;
    ``"batch"`` runs them within each ingestion hour of a zone.
    """
    if feature_scope not in FEATURE_SCOPES:
        raise ValueError(f"feature_scope must be one of {FEATURE_SCOPES}")
    energy = energy.drop(DAY)
    groups = ["zone"] if feature_scope == "history" else ["zone", VINTAGE]
    series = list(energy_series) + weather_series(cities, measures)
    joined = calendar_features(join_weather(energy, weather, cities, measures), "datetime")
    made = lag_rolling_features(
        joined, series, groups, ["datetime"], window_rows=WINDOW_ROWS,
        split_hot=split_hot, hot_options=hot_options, stats_df=with_vintage(energy),
    )
    first = with_vintage(energy).columns
    return fill_numeric(made.select(*first, *[c for c in made.columns if c not in first]), fill)


def build_forecasts(
    weather: DataFrame, hours: DataFrame | None = None, cities=CITIES, measures=MEASURES
) -> DataFrame:
    """Future weather of each vintage, one row per (ingested_hour_utc, datetime), with its offset.

    ``hours`` limits the vintages to those in it, as a semi join.
    """
    _, ahead = split_observed_forecast(with_vintage(weather, keep_raw=True), "datetime", VINTAGE)
    if hours is not None:
        ahead = ahead.join(broadcast_if_small(hours, SMALL_HOURS), VINTAGE, "left_semi")
    wide = pivot_measures(ahead, FORECAST_KEYS, "name", list(cities), list(measures), ["ingested_at"])
    return wide.withColumn("forecast_offset_h", forecast_offset("datetime", VINTAGE))
