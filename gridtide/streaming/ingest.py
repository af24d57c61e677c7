"""Incremental landing and merging of payload files with the file stream source.

Each run takes the files that are new since the last one (``availableNow``) and
stops; the checkpoint folder remembers which were taken.

A micro-batch comes with a session that is a copy of the caller's. It is written to the
shared checkpoint folder and read again by the caller's session, which so is the only
one that reads and writes a table, whether rows come by stream or by batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gridtide import schemas as S
from gridtide.operators import flatten_carbon, flatten_power
from gridtide.plans.silver import ENERGY_KEYS, WEATHER_KEYS, build_weather, join_feeds, latest_feed
from gridtide.session import staged, use_utc
from gridtide.sources import (
    append_table, fresh_table, insert_new_table, land_csv, land_json, land_table, read_days_of, table_exists, upsert_newest,
    upsert_table,
)

POWER, CARBON = "power_data", "carbon_intensity"


def each_new_batch(
    spark: SparkSession, stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand every micro-batch of new rows, read by ``spark``, and its number to ``write``, then stop."""
    def handle(batch: DataFrame, number: int) -> None:
        with staged(batch, spark) as written:
            write(written, number)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_json(
    spark: SparkSession, path: str, source: str, table: str, checkpoint: str, ingested_at: dt.datetime | Column | None = None
) -> StreamingQuery:
    """New JSON payload files under ``path`` to a bronze table, by the same landing as the batch job.

    A batch that is replayed after a failure, and files the batch job has landed
    already, are found in the table and add nothing.
    """
    use_utc(spark)
    stream = land_json(spark, path, source, ingested_at, stream=True)
    return each_new_batch(spark, stream, checkpoint, lambda batch, _: land_table(batch, table))


def stream_weather(
    spark: SparkSession, path: str, checkpoint: str, tz: str = S.WEATHER_TIME_ZONE, header_lines: int = 1
) -> StreamingQuery:
    """New weather payload files to the clean weather table, by insert-only merge.

    A batch that is replayed after a failure finds its keys present and adds nothing.
    """
    use_utc(spark)

    def write(batch: DataFrame, _: int) -> None:
        insert_new_table(spark, S.SILVER_WEATHER, build_weather(batch, tz, header_lines), WEATHER_KEYS)

    return each_new_batch(spark, land_csv(spark, path, stream=True), checkpoint, write)


def stream_energy(
    spark: SparkSession,
    power_path: str,
    carbon_path: str,
    checkpoint: str,
    target: str = S.SILVER_ENERGY,
    ingested_at: dt.datetime | Column | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """New power and carbon payload files to the clean energy table, by upsert of the hours they concern.

    The newest revision of each feed's hours is kept in ``<target>_power`` and ``<target>_carbon``. A batch merges its hours
    there, reads both feeds back on the days it touches, and upserts the hours that both have. Feeds may come in any order
    and a revision that arrives after a newer one changes nothing. ``<target>_batches`` records the batches that
    are through; a batch that is replayed is skipped, and one that failed half-way merges the same rows again.
    """
    use_utc(spark)
    feeds = {POWER: f"{target}_power", CARBON: f"{target}_carbon"}
    flatten = {POWER: lambda rows: flatten_power(rows, strict), CARBON: flatten_carbon}
    batches = f"{target}_batches"

    def done(number: int) -> bool:
        mine = (F.col("checkpoint") == checkpoint) & (F.col("batch") == number)
        return table_exists(spark, batches) and not fresh_table(spark, batches).filter(mine).isEmpty()

    def newest(feed: str, keys: DataFrame) -> DataFrame:
        suffix = "power" if feed == POWER else "carbon"
        rows = read_days_of(spark, feeds[feed], keys).join(keys, ENERGY_KEYS, "left_semi")
        return latest_feed(rows, suffix)

    def write(batch: DataFrame, number: int) -> None:
        if done(number):
            return
        touched = None
        for feed, table in feeds.items():
            rows = flatten[feed](batch.filter(F.col("source") == feed)).dropna(subset=ENERGY_KEYS)
            upsert_newest(spark, table, rows, ENERGY_KEYS, ["ingested_at"])
            touched = rows.select(*ENERGY_KEYS) if touched is None else touched.union(rows.select(*ENERGY_KEYS))
        with staged(touched.distinct()) as keys:
            upsert_table(spark, target, join_feeds(newest(POWER, keys), newest(CARBON, keys)), ENERGY_KEYS)
        append_table(spark.createDataFrame([(checkpoint, number)], "checkpoint string, batch long"), batches)

    both = land_json(spark, power_path, POWER, ingested_at, stream=True).unionByName(
        land_json(spark, carbon_path, CARBON, ingested_at, stream=True)
    )
    return each_new_batch(spark, both, checkpoint, write)
