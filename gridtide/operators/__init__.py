from gridtide.operators.changes import changed_rows
from gridtide.operators.flatten import (
    explode_history, flatten_carbon, flatten_power, flatten_weather, map_to_columns,
)
from gridtide.operators.hot import hot_groups, sliced
from gridtide.operators.merge import insert_new, upsert
from gridtide.operators.pivot import pivot_measures
from gridtide.operators.ranges import (
    anchored_lookback, at_time, from_time, horizon, lookback, split_observed_forecast,
)
from gridtide.operators.sizes import broadcast_if_small
from gridtide.operators.timeframes import time_range_features
from gridtide.operators.windows import lag_rolling_features, latest_per_key, latest_snapshot

__all__ = [
    "anchored_lookback", "at_time", "broadcast_if_small", "changed_rows", "explode_history", "flatten_carbon", "flatten_power",
    "flatten_weather", "from_time", "horizon", "hot_groups", "insert_new", "lag_rolling_features", "latest_per_key", "latest_snapshot",
    "lookback", "map_to_columns", "pivot_measures", "sliced", "split_observed_forecast", "time_range_features",
    "upsert",
]
