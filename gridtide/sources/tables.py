"""Named Parquet tables: scan, append, upsert, insert-only merge.

A merge table is partitioned by the day of a timestamp column. A merge rewrites
only the days its source touches (dynamic partition overwrite), or only appends
when nothing has to change. Parquet has no transaction log: one writer at a
time, and readers may see a merge half-way through its commit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.operators.merge import unmatched_source, upsert
from gridtide.operators.windows import latest_per_key
from gridtide.schemas import DAY, FILE, FILE_TIME
from gridtide.session import staged

# Up to this many source rows are broadcast (a few hundred bytes each).
_SMALL_SOURCE = 100_000
# Is called with the rows that go and those that come, before a merge writes.
OnChange = Callable[[DataFrame, DataFrame], None]
# Columns of bookkeeping, which readers see only on request.
_HIDDEN = (DAY, FILE, FILE_TIME)
_GONE = "__gone"


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create the schema of table ``name`` (or the schema ``name`` itself) if it is missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def fresh_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now, also if another session (a stream's, say) has written to it since it was last read."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, name: str, with_day: bool = False) -> DataFrame:
    """The table; its partition column only on request (``from_time``, ``at_time`` and ``lookback`` use it)."""
    df = fresh_table(spark, name).drop(FILE, FILE_TIME)
    return df if with_day else df.drop(DAY)


def append_table(df: DataFrame, name: str, ts_col: str | None = None) -> None:
    """Append, creating schema and table on the first run; partitioned by the day of ``ts_col`` if one is named."""
    ensure_schema(df.sparkSession, name)
    if ts_col is None:
        df.write.mode("append").format("parquet").saveAsTable(name)
    elif table_exists(df.sparkSession, name):
        by_day = _rebalanced(_by_day(df, ts_col))
        by_day.select(*df.sparkSession.table(name).columns).write.insertInto(name)
    else:
        _rebalanced(_by_day(df, ts_col)).write.format("parquet").partitionBy(DAY).saveAsTable(name)


def land_table(files: DataFrame, name: str, ts_col: str = "ingested_at") -> None:
    """Append landed files that the table does not hold yet, each once.

    A file is known by its path and modification time, so landing a folder again,
    by batch or by stream, adds only what is new in it. The table is partitioned by
    the day of ``ts_col``. Only the two columns of the table are read for this, and the
    texts of known files are not.
    """
    spark = files.sparkSession
    if table_exists(spark, name):
        files = unmatched_source(fresh_table(spark, name), files, [FILE, FILE_TIME])
    append_table(files, name, ts_col)


def _by_day(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(ts_col))


def _rebalanced(df: DataFrame) -> DataFrame:
    # Adaptive execution merges small days into one task and cuts large ones.
    return df.hint("rebalance", F.col(DAY))


def _create(df: DataFrame, name: str) -> None:
    ensure_schema(df.sparkSession, name)
    _rebalanced(df).write.format("parquet").mode("overwrite").partitionBy(DAY).saveAsTable(name)


def _on_days_of(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``table`` on the days of ``batch``, and on no other day.

    The days (some 37,000 in a century) are broadcast to a semi join on the partition
    column, which prunes the scan. Rows without a day belong together.
    """
    days = batch.select(DAY).distinct()
    kept = table.join(F.broadcast(days), DAY, "left_semi")
    if days.filter(F.col(DAY).isNull()).isEmpty():
        return kept
    return kept.unionByName(table.filter(F.col(DAY).isNull()))


def read_days_of(spark: SparkSession, name: str, rows: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """The rows of table ``name`` on the days that ``rows`` touch; no other day is read."""
    return _on_days_of(fresh_table(spark, name), _by_day(rows.select(ts_col), ts_col)).drop(DAY)


def upsert_newest(spark: SparkSession, name: str, source: DataFrame, keys: list[str], newest_by: list[str], ts_col: str = "datetime") -> None:
    """Merge ``source`` so that each key keeps its newest row, in whatever order rows arrive.

    A row that is older than the table's changes nothing, so merging again or out of order gives the same table.
    """
    with staged(latest_per_key(source, keys, newest_by)) as batch:
        if table_exists(spark, name):
            known = read_days_of(spark, name, batch, ts_col).join(batch.select(*keys), keys, "left_semi").select(*batch.columns)
            batch = latest_per_key(known.unionByName(batch), keys, newest_by)
        upsert_table(spark, name, batch, keys, ts_col)


def upsert_table(
    spark: SparkSession, name: str, source: DataFrame, keys: list[str], ts_col: str = "datetime", validate: bool = True,
    on_change: OnChange | None = None,
) -> None:
    """Merge ``source`` into table ``name``: replace matched rows, add the others.

    ``ts_col`` must be one of ``keys``, so a row never moves to another day. The
    source is written out first: it is read several times, and what is merged
    must be what the touched days were taken from.
    """
    if ts_col not in keys:
        raise ValueError(f"{ts_col} must be one of the keys")
    if not table_exists(spark, name):
        _create(_by_day(source, ts_col), name)
        return
    with staged(_by_day(source, ts_col)) as batch:
        n = batch.count()
        if not n:
            return
        current = _on_days_of(fresh_table(spark, name), batch)
        if on_change:
            on_change(current.join(batch.select(*keys), keys, "left_semi"), batch.select(*current.columns))
        merged = upsert(current, batch.select(*current.columns), keys, validate, n <= _SMALL_SOURCE)
        _overwrite_days(spark, _rebalanced(merged), name)


def _overwrite_days(spark: SparkSession, df: DataFrame, name: str) -> None:
    # insertInto takes the mode from the session alone, so one merge at a time per session.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def replace_from(
    spark: SparkSession, name: str, source: DataFrame, starts: DataFrame, group: str, start: str, ts_col: str = "datetime",
    on_change: OnChange | None = None,
) -> None:
    """Replace, in each group of ``starts``, the rows at or after its ``start`` by ``source``.

    Rows of the table in that range that ``source`` lacks are deleted. Other groups
    and earlier rows stay; only days that hold a row to delete or to add are
    rewritten, and a day that loses its last row is emptied.
    """
    if not table_exists(spark, name):
        _create(_by_day(source, ts_col), name)
        return
    with staged(_by_day(source, ts_col)) as batch, staged(starts.select(group, start)) as ranges:
        table = fresh_table(spark, name)
        since = ranges.agg(F.to_date(F.min(start))).scalar()
        marked = table.filter(F.col(DAY) >= since).join(
            ranges.select(F.col(group).alias("__g"), F.col(start).alias("__s")), F.col(group) == F.col("__g"), "left"
        )
        _swap(spark, name, marked.withColumn(_GONE, F.coalesce(F.col(ts_col) >= F.col("__s"), F.lit(False))), batch, on_change)


def replace_marked(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    days: DataFrame,
    mark: Callable[[DataFrame, str], DataFrame],
    ts_col: str = "datetime",
) -> None:
    """Replace the rows on ``days`` that ``mark`` gives a true value in the column it is told to add, by ``source``.

    Rows so marked that ``source`` lacks are deleted. As in ``replace_from``, only days that hold a row to delete
    or to add are rewritten.
    """
    if not table_exists(spark, name):
        _create(_by_day(source, ts_col), name)
        return
    with staged(_by_day(source, ts_col)) as batch, staged(days.select(DAY).distinct()) as near:
        _swap(spark, name, mark(_on_days_of(fresh_table(spark, name), near), _GONE), batch)


def _swap(spark: SparkSession, name: str, marked: DataFrame, batch: DataFrame, on_change: OnChange | None = None) -> None:
    """Delete the marked rows and add ``batch``, rewriting only the days on which a row goes or comes."""
    columns = spark.table(name).columns
    if on_change:
        on_change(marked.filter(_GONE).select(*columns), batch.select(*columns))
    days = batch.select(DAY).unionByName(marked.filter(_GONE).select(DAY))
    with staged(days.distinct()) as touched:
        stay = _on_days_of(marked.filter(f"NOT {_GONE}").select(*columns), touched)
        with staged(stay.unionByName(batch.select(*columns))) as merged:
            _overwrite_days(spark, _rebalanced(merged), name)
            lost = [r[0] for r in touched.join(merged.select(DAY).distinct(), DAY, "left_anti").collect()]
            for day in lost:
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({DAY} = DATE '{day}')")


def insert_new_table(
    spark: SparkSession, name: str, source: DataFrame, keys: list[str], ts_col: str = "datetime"
) -> None:
    """Append the rows of ``source`` whose keys table ``name`` lacks; nothing is rewritten."""
    if ts_col not in keys:
        raise ValueError(f"{ts_col} must be one of the keys")
    if not table_exists(spark, name):
        _create(_by_day(source, ts_col), name)
        return
    with staged(_by_day(source, ts_col)) as batch:
        fresh = unmatched_source(_on_days_of(fresh_table(spark, name), batch), batch, keys)
        _rebalanced(fresh).select(*spark.table(name).columns).write.insertInto(name)
