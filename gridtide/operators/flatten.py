"""Raw JSON and CSV payloads to rows, with built-in expressions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.timeops import local_to_utc, parse_utc
from gridtide.schemas import (
    FUELS, NEIGHBOURS, WEATHER_COLUMNS, WEATHER_TEXT_COLUMNS, WEATHER_TIME_ZONE,
    carbon_schema, power_schema, weather_schema,
)

# One CSV record: runs of plain characters and quoted parts (which may hold line
# breaks). A quote that is never closed counts as a plain character.
_CSV_RECORD = r'(?:[^"\r\n]++|"[^"]*+"|")++'


def map_to_columns(map_col: str | Column, keys: Iterable[str], prefix: str, rounded: bool = False) -> list[Column]:
    """A column ``{prefix}_{key}`` per key; a missing key gives NULL, other keys are dropped."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    values = ((k, m[k]) for k in keys)
    return [(F.round(v).cast("bigint") if rounded else v).alias(f"{prefix}_{k}") for k, v in values]


def explode_history(df: DataFrame, history: Column, keep: Iterable[str] = ("ingested_at",)) -> DataFrame:
    """One row ``h`` per element; NULL or empty arrays give none."""
    return df.select(*keep, F.explode(history).alias("h"))


def flatten_power(
    bronze: DataFrame, strict: bool = False,
    fuels: Iterable[str] = FUELS, neighbours: Iterable[str] = NEIGHBOURS,
) -> DataFrame:
    """Rows (zone, datetime, breakdowns, totals) of the power payloads in ``raw_json``.

    Payloads that cannot be parsed or have no history give no row.
    """
    parsed = F.from_json("raw_json", power_schema(strict))
    rounded = not strict

    def part(side: str, keys: Iterable[str]) -> list[Column]:
        return map_to_columns(F.col(f"h.power{side}Breakdown"), keys, side.lower(), rounded)

    def total(side: str) -> Column:
        return F.col(f"h.power{side}Total").alias(f"{side.lower()}_total")

    return explode_history(bronze, parsed["history"]).select(
        "ingested_at",
        "h.zone",
        parse_utc("h.datetime").alias("datetime"),
        "h.isEstimated",
        *part("Consumption", fuels), total("Consumption"),
        *part("Production", fuels), total("Production"),
        total("Import"), total("Export"),
        *part("Import", neighbours), *part("Export", neighbours),
    )


def flatten_carbon(bronze: DataFrame) -> DataFrame:
    """Rows (zone, datetime, carbon_intensity) of the carbon payloads in ``raw_json``."""
    parsed = F.from_json("raw_json", carbon_schema())
    return explode_history(bronze, parsed["history"]).select(
        "ingested_at",
        "h.zone",
        parse_utc("h.datetime").alias("datetime"),
        "h.isEstimated",
        F.col("h.carbonIntensity").alias("carbon_intensity"),
    )


def flatten_weather(bronze: DataFrame, tz: str = WEATHER_TIME_ZONE, header_lines: int = 1) -> DataFrame:
    """Rows of the weather payloads in ``raw_csv``, times shifted from ``tz`` to UTC.

    The first ``header_lines`` records are skipped and columns are taken by
    position. Missing and NaN numbers become NULL.
    """
    records = F.regexp_extract_all("raw_csv", F.lit(_CSV_RECORD), F.lit(0))
    lines = bronze.select("ingested_at", F.posexplode(records).alias("pos", "line"))
    parsed = lines.filter(F.col("pos") >= header_lines).select(
        "ingested_at", F.from_csv("line", weather_schema(), {"escape": '"'}).alias("r")
    )

    def value(c: str) -> Column:
        if c == "datetime":
            return local_to_utc("r.datetime", tz).alias(c)
        field = F.col(f"r.{c}")
        if c not in WEATHER_TEXT_COLUMNS:
            field = F.when(~F.isnan(field), field)
        return field.alias(c)

    return parsed.select(*[value(c) for c in WEATHER_COLUMNS], "ingested_at")
