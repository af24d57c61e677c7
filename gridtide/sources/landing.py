"""Landed payload files to bronze rows: one file, one row, the text kept whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from gridtide.functions.timeops import instant
from gridtide.schemas import FILE, FILE_TIME

_TEXT = T.StructType([T.StructField("value", T.StringType())])
_CSV_TEXT = T.StructType([T.StructField("value", T.StringType()), T.StructField("location_name", T.StringType())])


def _stamp(ingested_at: dt.datetime | Column | None) -> Column:
    # The file time, unlike the clock, is the same when a lost task is run again.
    if ingested_at is None:
        return F.col("_metadata.file_modification_time").cast("timestamp")
    return instant(ingested_at)


def _read(spark: SparkSession, path: str, schema: T.StructType, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("text").schema(schema).option("wholetext", True).option("recursiveFileLookup", False).load(path)


def _file() -> list[Column]:
    """What tells files apart when a folder is landed again."""
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").cast("timestamp").alias(FILE_TIME),
    ]


def land_json(
    spark: SparkSession, path: str, source: str, ingested_at: dt.datetime | Column | None = None, stream: bool = False
) -> DataFrame:
    """(source, raw_json, ingested_at, file path and time) of the payload files under ``path``."""
    files = _read(spark, path, _TEXT, stream)
    return files.select(
        F.lit(source).alias("source"), F.col("value").alias("raw_json"), _stamp(ingested_at).alias("ingested_at"), *_file()
    )


def land_csv(
    spark: SparkSession, path: str, ingested_at: dt.datetime | Column | None = None, stream: bool = False
) -> DataFrame:
    """(location_name, raw_csv, ingested_at, file path and time) of the files under ``path/location_name=…/``."""
    files = _read(spark, path, _CSV_TEXT, stream)
    return files.select(
        "location_name", F.col("value").alias("raw_csv"), _stamp(ingested_at).alias("ingested_at"), *_file()
    )
