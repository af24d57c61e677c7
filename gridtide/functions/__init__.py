from gridtide.functions.columns import (
    drop_incomplete, feature_columns, fill_numeric, numeric_columns,
)
from gridtide.functions.timeops import (
    calendar_columns, calendar_features, forecast_offset, instant, local_to_utc, parse_utc,
    round_to_hour,
)

__all__ = [
    "calendar_columns", "calendar_features", "drop_incomplete", "feature_columns", "fill_numeric",
    "forecast_offset", "instant", "local_to_utc", "numeric_columns", "parse_utc", "round_to_hour",
]
