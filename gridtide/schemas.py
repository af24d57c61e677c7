"""Column lists and payload schemas.

The values here are fixed: payload field names, keys and table columns must
match the feeds and the tables that users of the pipeline already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: map keys kept from the power breakdowns -------------------
FUELS = ("nuclear", "geothermal", "biomass", "coal", "wind", "solar", "hydro", "gas", "oil")
NEIGHBOURS = ("AL", "BG", "MK", "TR")

# --- fixed values: weather locations and measures ----------------------------
CITIES = ("Athens, Greece", "Heraklion, Greece", "Thessaloniki, Greece")
COUNTRY_SUFFIX = ", Greece"
MEASURES = ("temp", "humidity", "precip", "windspeed", "solarenergy", "winddir", "cloudcover")

# --- fixed values: text form of payload timestamps ---------------------------
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
WEATHER_TIME_ZONE = "EET"

# --- fixed values: table names -----------------------------------------------
BRONZE_POWER = "bronze.power_data"
BRONZE_CARBON = "bronze.carbon_data"
BRONZE_WEATHER = "bronze.weather_forecast_data"
SILVER_ENERGY = "silver.energy_data"
SILVER_WEATHER = "silver.weather_forecast_data"
GOLD_HISTORIC = "gold.historic_data"
GOLD_FORECASTS = "gold.weather_forecasts"
GOLD_TRAINING = "gold.training_data"
GOLD_PREDICTIONS = "gold.carbon_intensity_predictions"
GOLD_MODELS = "gold.models"
GOLD_MONITORING = "gold.prediction_quality"

# Tables of this package's own bookkeeping.
PROGRESS = "meta.progress"
GOLD_CHANGES = "gold.changes"
GOLD_ERROR_CHANGES = "gold.error_changes"
GOLD_ERRORS = "gold.prediction_errors"
GOLD_ALARMS = "gold.quality_alarms"

# Partition column of the merge tables: the day of ``datetime``.
DAY = "_day"
# Bookkeeping of landed files in the bronze tables: path and modification time.
FILE, FILE_TIME = "_file", "_file_time"

# --- fixed values: column prefixes and names that mark features --------------
HISTORY_PREFIXES = ("lag_", "rolling_avg_")
FORECAST_PREFIXES = tuple(f"{m}_" for m in MEASURES)
CALENDAR = ("hour_of_day", "day_of_week", "month", "day_of_year", "week_of_year")
TIME_FEATURES = ("forecast_offset_h",) + CALENDAR
TARGET = "carbon_intensity"
LABEL = "target_val"

# Energy columns that get lag and rolling features (31).
ENERGY_SERIES = (
    (TARGET,)
    + tuple(f"consumption_{f}" for f in FUELS + ("total",))
    + tuple(f"production_{f}" for f in FUELS + ("total",))
    + ("import_total", "export_total")
    + tuple(f"import_{n}" for n in NEIGHBOURS)
    + tuple(f"export_{n}" for n in NEIGHBOURS)
)

# silver.energy_data, in order (37).
ENERGY_COLUMNS = (
    ("zone", "datetime", "ingested_at", "ingested_at_carbon", "isEstimated_power", "isEstimated_carbon")
    + ENERGY_SERIES[1:]
    + (TARGET,)
)

# Positional columns of a weather payload (12).
WEATHER_COLUMNS = (
    "name", "latitude", "longitude", "datetime", "temp", "humidity", "precip",
    "windspeed", "winddir", "cloudcover", "solarenergy", "stations",
)
WEATHER_TEXT_COLUMNS = ("name", "datetime", "stations")


def _history(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField("history", T.ArrayType(T.StructType(fields)))])


def power_schema(strict: bool = False) -> T.StructType:
    """Power payload: only the fields that end up in a column.

    ``strict`` reads breakdowns as ``map<string,bigint>``, where one fractional
    value makes the whole map NULL; otherwise they are read as doubles.
    """
    breakdown = T.MapType(T.StringType(), T.LongType() if strict else T.DoubleType())
    sides = ("Consumption", "Production", "Import", "Export")
    return _history(
        [T.StructField("zone", T.StringType()), T.StructField("datetime", T.StringType())]
        + [T.StructField(f"power{s}Breakdown", breakdown) for s in sides]
        + [T.StructField(f"power{s}Total", T.LongType()) for s in sides]
        + [T.StructField("isEstimated", T.BooleanType())]
    )


def carbon_schema() -> T.StructType:
    """Carbon-intensity payload: only the fields that end up in a column."""
    return _history(
        [
            T.StructField("zone", T.StringType()),
            T.StructField("datetime", T.StringType()),
            T.StructField("carbonIntensity", T.LongType()),
            T.StructField("isEstimated", T.BooleanType()),
        ]
    )


def weather_schema() -> str:
    """Weather CSV line; ``datetime`` stays text until the zone shift."""
    return ", ".join(f"{c} {'string' if c in WEATHER_TEXT_COLUMNS else 'double'}" for c in WEATHER_COLUMNS)


def sanitize(location: str, suffix: str = COUNTRY_SUFFIX) -> str:
    """Column-name form of a location: no country suffix, underscores, lower case."""
    return location.replace(suffix, "").replace(" ", "_").lower()
