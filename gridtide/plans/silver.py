"""Clean tables from raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridtide.operators import flatten_carbon, flatten_power, flatten_weather, latest_per_key
from gridtide.schemas import ENERGY_COLUMNS, WEATHER_TIME_ZONE

ENERGY_KEYS = ["zone", "datetime"]
WEATHER_KEYS = ["name", "datetime", "ingested_at"]


def latest_feed(flat: DataFrame, suffix: str) -> DataFrame:
    """Latest revision of each hour of one feed, with its bookkeeping columns renamed."""
    return latest_per_key(flat, ENERGY_KEYS, ["ingested_at"]).withColumnsRenamed(
        {"isEstimated": f"isEstimated_{suffix}", "ingested_at": f"ingested_at_{suffix}"}
    )


def join_feeds(power: DataFrame, carbon: DataFrame) -> DataFrame:
    """Hours present in both feeds. Both sides come partitioned by the keys already."""
    joined = power.join(carbon, ENERGY_KEYS, "inner").withColumnRenamed("ingested_at_power", "ingested_at")
    return joined.select(*ENERGY_COLUMNS)


def build_energy(power_bronze: DataFrame, carbon_bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Power and carbon payloads to one row per (zone, datetime), 37 columns; rows without a key are left out."""
    power = latest_feed(flatten_power(power_bronze, strict).dropna(subset=ENERGY_KEYS), "power")
    carbon = latest_feed(flatten_carbon(carbon_bronze).dropna(subset=ENERGY_KEYS), "carbon")
    return join_feeds(power, carbon)


def build_weather(bronze: DataFrame, tz: str = WEATHER_TIME_ZONE, header_lines: int = 1) -> DataFrame:
    """Weather payloads to one row per (name, datetime, ingested_at), 13 columns; every vintage stays.

    Rows without a name, a readable time or an ingestion time are left out: their
    keys never match, so each run would add them again.
    """
    return flatten_weather(bronze, tz, header_lines).dropna(subset=WEATHER_KEYS)


def latest_weather(weather: DataFrame) -> DataFrame:
    """The latest vintage of each (name, datetime)."""
    return latest_per_key(weather, ["name", "datetime"], ["ingested_at"])
