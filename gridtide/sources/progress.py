"""High-water marks: how far each reader of a table has come.

A mark is committed after the reader's own write. A run that dies in between takes the same
rows again, so what it writes must be safe to repeat (a merge is).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.schemas import PROGRESS
from gridtide.sources.tables import ensure_schema, fresh_table, table_exists


def marks(spark: SparkSession, readers: list[str], name: str = PROGRESS) -> dict[str, dt.datetime | None]:
    """The mark of each reader, as naive UTC; None for one that has committed none.

    A mark never falls: the highest one committed counts.
    """
    found: dict[str, dt.datetime | None] = dict.fromkeys(readers)
    if not table_exists(spark, name):
        return found
    rows = fresh_table(spark, name).filter(F.col("reader").isin(readers)).groupBy("reader").agg(
        F.unix_micros(F.max("mark")).alias("at")
    )
    for reader, at in rows.collect():
        found[reader] = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=at)
    return found


def high_water(df: DataFrame, ts_col: str = "ingested_at") -> dt.datetime | None:
    """The latest time in ``df``, as naive UTC; None without one."""
    at = df.agg(F.unix_micros(F.max(ts_col))).head()[0]
    return None if at is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=at)


def commit_marks(spark: SparkSession, reached: dict[str, dt.datetime | None], name: str = PROGRESS) -> None:
    """Record how far readers have come; one that found nothing (None) keeps its mark."""
    epoch = dt.datetime(1970, 1, 1)
    rows = [(r, (at - epoch) // dt.timedelta(microseconds=1)) for r, at in reached.items() if at is not None]
    if not rows:
        return
    ensure_schema(spark, name)
    new = spark.createDataFrame(rows, "reader string, at long").select("reader", F.timestamp_micros("at").alias("mark"))
    new.coalesce(1).write.mode("append").format("parquet").saveAsTable(name)


def hours_since(at: dt.datetime | None, now: dt.datetime | None) -> int:
    """Whole hours, rounded up, from ``at`` to ``now``, so that a lookback of so many reaches ``at``; 0 if either is unknown."""
    if at is None or now is None:
        return 0
    return max(0, -((at - now) // dt.timedelta(hours=1)))
