"""24-hour batch scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions import calendar_columns, drop_incomplete, feature_columns, instant
from gridtide.operators import from_time, horizon, latest_snapshot
from gridtide.plans.gold import VINTAGE
from gridtide.schemas import FORECAST_PREFIXES, HISTORY_PREFIXES

PREDICTION_COLUMNS = (VINTAGE, "datetime", "prediction", "prediction_ingested_at", "model_version")
ANCHORS = ("global", "group")


def build_scoring(
    historic: DataFrame, forecasts: DataFrame, horizon_hours: int = 24, group: str = "zone", anchor: str = "global"
) -> DataFrame:
    """Feature rows for the hours after the latest history row.

    The anchor is the latest ``datetime`` of all history, or with
    ``anchor="group"`` of each zone. The forecasts are those of the vintage
    equal to the anchor's hour; without any the result is empty.
    """
    if anchor not in ANCHORS:
        raise ValueError(f"anchor must be one of {ANCHORS}")
    snapshot_cols = feature_columns(historic, HISTORY_PREFIXES)
    forecast_cols = feature_columns(forecasts, FORECAST_PREFIXES)
    if anchor == "global":
        latest = latest_snapshot(historic, "datetime")
        vintage = historic.agg(F.date_trunc("hour", F.max("datetime"))).scalar()
        forecasts = forecasts.filter(F.col(VINTAGE) == vintage)
    else:
        newest = historic.groupBy(group).agg(F.max("datetime").alias("datetime"))
        latest = historic.join(newest, [group, "datetime"], "left_semi")
        vintage = newest.agg(F.date_trunc("hour", F.min("datetime"))).scalar()
        forecasts = forecasts.filter(F.col(VINTAGE) >= vintage)
    # Hours ahead lie after their vintage, so earlier days of the table are not read.
    forecasts = from_time(forecasts, vintage)
    snapshot = latest.select(group, F.date_trunc("hour", "datetime").alias(VINTAGE), *snapshot_cols)
    ahead = drop_incomplete(horizon(forecasts, horizon_hours))
    # An equi-join on the vintage; the snapshot has one row per zone.
    return ahead.join(snapshot, VINTAGE, "inner").select(
        group, VINTAGE, "datetime", *forecast_cols, "forecast_offset_h", *calendar_columns("datetime"), *snapshot_cols
    )


def score(
    model: PipelineModel, rows: DataFrame, version: int | str, group: str = "zone",
    stamped_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Predictions with their keys: the group and the five prediction columns."""
    stamp = F.current_timestamp() if stamped_at is None else instant(stamped_at)
    return model.transform(rows).select(
        VINTAGE,
        "datetime",
        "prediction",
        stamp.alias("prediction_ingested_at"),
        F.lit(str(version)).alias("model_version"),
        group,
    )
