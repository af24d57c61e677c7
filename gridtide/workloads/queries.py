"""One query per operator or builder, each over whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide import functions as fx
from gridtide import operators as op
from gridtide import sources
from gridtide.model import gbt
from gridtide.model.monitor import change_alarms, error_sums, match_actuals, monitor, quality_report
from gridtide.model.scoring import build_scoring, score
from gridtide.plans import gold, jobs, silver, training
from gridtide.session import ensure_checkpoint_dir, materialize
from gridtide.streaming import ingest
from gridtide.workloads import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
LOOKBACK_END = dt.datetime(2024, 1, 31)
# Sizes that make every user of the test tables a hot group, to exercise the sliced path.
SMALL_SLICES = {"min_rows": 5, "slice_rows": 500}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Instants as wall-clock times, columns with a ``rounded`` prefix at six places."""
    def out(name: str, kind: str) -> str:
        if kind == "timestamp":
            return f"CAST(`{name}` AS timestamp_ntz) AS `{name}`"
        if kind == "double" and name.startswith(rounded):
            return f"round(`{name}`, 6) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[out(n, k) for n, k in df.dtypes])


def events(spark, sf_dir):
    return feeds.load(spark, sf_dir, "events")


def orders(spark, sf_dir):
    return feeds.load(spark, sf_dir, "orders")


# --- payloads ------------------------------------------------------------------

@query
def json_flatten(spark, sf_dir):
    parsed = events(spark, sf_dir).withColumn("m", F.from_json("props", "map<string,bigint>"))
    return parsed.select("event_id", *op.map_to_columns("m", ["k", "absent"], "prop"))


@query
def power_revisions(spark, sf_dir):
    return plain(op.flatten_power(feeds.power_bronze(spark, sf_dir)))


@query
def carbon_revisions(spark, sf_dir):
    return plain(op.flatten_carbon(feeds.carbon_bronze(spark, sf_dir)))


@query
def csv_flatten(spark, sf_dir):
    return plain(op.flatten_weather(feeds.weather_bronze(spark, sf_dir)))


# --- landed files and tables ---------------------------------------------------------

def _land(spark, payloads: DataFrame, text: str, folder: str | None = None) -> str:
    """Write one file per payload to (by default a new folder in) the shared checkpoint folder; returns the folder."""
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4()}"
    keys = [c for c in payloads.columns if c != text]
    payloads.repartition(*keys).write.mode("append").partitionBy(*keys).text(folder)
    return folder


def _delivered_at():
    return feeds.plus_minutes(F.col("v").cast("timestamp"), 10)


@query
def land_json_files(spark, sf_dir):
    folder = _land(spark, feeds.power_payloads(spark, sf_dir), "raw_json")
    return plain(op.flatten_power(sources.land_json(spark, folder, "power_data", _delivered_at())))


@query
def land_csv_files(spark, sf_dir):
    folder = _land(spark, feeds.weather_payloads(spark, sf_dir), "raw_csv")
    return plain(op.flatten_weather(sources.land_csv(spark, folder, _delivered_at())))


@contextmanager
def _scratch_table(spark):
    """Name of a table in a schema of its own under the shared checkpoint folder."""
    schema = f"check_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{ensure_checkpoint_dir(spark).rstrip('/')}/{schema}'")
    try:
        yield f"{schema}.t"
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


@query
def ingest_twice(spark, sf_dir):
    """A folder landed four times, files being added in between: each file once."""
    folder = _land(spark, feeds.power_payloads(spark, sf_dir, (0,)), "raw_json")
    with _scratch_table(spark) as name:
        for added in ((), (), (1,), ()):
            if added:
                _land(spark, feeds.power_payloads(spark, sf_dir, added), "raw_json", folder)
            sources.land_table(sources.land_json(spark, folder, "power_data", _delivered_at()), name)
        return plain(materialize(op.flatten_power(sources.read_table(spark, name))))


def _path_delivered_at():
    """The same as ``_delivered_at`` for a file stream, which has no partition columns: the folder's name, escaped as a folder and as an address."""
    folder = F.url_decode(F.url_decode(F.regexp_extract("_metadata.file_path", "/v=([^/]+)/", 1)))
    return feeds.plus_minutes(folder.cast("timestamp"), 10)


def _checkpoint(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4()}"


@query
def ingest_streamed(spark, sf_dir):
    """One table by batch, stream, batch and a stream that replays all files: each file once."""
    folder = _land(spark, feeds.power_payloads(spark, sf_dir, (0,)), "raw_json")
    first = _checkpoint(spark)
    with _scratch_table(spark) as name:
        sources.land_table(sources.land_json(spark, folder, "power_data", _delivered_at()), name)
        ingest.stream_json(spark, f"{folder}/*/*", "power_data", name, first, _path_delivered_at()).awaitTermination()
        _land(spark, feeds.power_payloads(spark, sf_dir, (1,)), "raw_json", folder)
        ingest.stream_json(spark, f"{folder}/*/*", "power_data", name, first, _path_delivered_at()).awaitTermination()
        sources.land_table(sources.land_json(spark, folder, "power_data", _delivered_at()), name)
        ingest.stream_json(spark, f"{folder}/*/*", "power_data", name, _checkpoint(spark), _path_delivered_at()).awaitTermination()
        return plain(materialize(op.flatten_power(sources.read_table(spark, name))))


@query
def energy_streamed(spark, sf_dir):
    """Two feeds merged by a stream: revisions first, what they revise afterwards, then all files again."""
    power = _land(spark, feeds.power_payloads(spark, sf_dir, (1,)), "raw_json")
    carbon = _land(spark, feeds.carbon_payloads(spark, sf_dir), "raw_json")
    first = _checkpoint(spark)
    with _scratch_table(spark) as name:
        for late, checkpoint in (((), first), ((0,), first), ((), _checkpoint(spark))):
            if late:
                _land(spark, feeds.power_payloads(spark, sf_dir, late), "raw_json", power)
            ingest.stream_energy(spark, f"{power}/*/*", f"{carbon}/*/*", checkpoint, name, _path_delivered_at()).awaitTermination()
        return plain(materialize(sources.read_table(spark, name)))


@query
def table_append(spark, sf_dir):
    with _scratch_table(spark) as name:
        for lag in (0, 1):
            sources.append_table(feeds.power_bronze(spark, sf_dir, (lag,)), name)
        return plain(materialize(op.flatten_power(sources.read_table(spark, name))))


@query
def table_upsert(spark, sf_dir):
    """All zones as first delivered; then two of them deliver again."""
    again = feeds.energy(spark, sf_dir).filter(F.col("zone").isin("click", "view"))
    with _scratch_table(spark) as name:
        for source in (feeds.energy(spark, sf_dir, lag=0), again):
            sources.upsert_table(spark, name, source, silver.ENERGY_KEYS)
        return plain(materialize(sources.read_table(spark, name)))


@query
def table_insert_new(spark, sf_dir):
    """Two overlapping loads; the vintages in both are kept once."""
    with _scratch_table(spark) as name:
        for lags in ((-2, -1), (-1, 0, 1)):
            sources.insert_new_table(spark, name, feeds.weather(spark, sf_dir, lags), silver.WEATHER_KEYS)
        return plain(materialize(sources.read_table(spark, name)))


# --- clean tables ----------------------------------------------------------------

@query
def silver_after_a_pause(spark, sf_dir):
    """Both feeds merged with a lookback of 12 hours, after pauses of 36 hours and of a fortnight; the last run is repeated."""
    ends = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11, 12), dt.datetime(2024, 1, 25), dt.datetime(2024, 3, 1)]
    feed = {"power": feeds.power_bronze(spark, sf_dir), "carbon": feeds.carbon_bronze(spark, sf_dir)}
    feed = {kind: materialize(rows) for kind, rows in feed.items()}
    with _scratch_table(spark) as name:
        tables = {kind: f"{name}_{kind}" for kind in feed}
        since = dt.datetime(2000, 1, 1)
        for i, end in enumerate([*ends, ends[-1]]):
            for kind, rows in feed.items():
                arrived = rows.filter((F.col("ingested_at") >= fx.instant(since)) & (F.col("ingested_at") < fx.instant(end)))
                sources.append_table(arrived, tables[kind], "ingested_at")
            hours = 12 if i else 24 * 400
            jobs.merge_energy(spark, hours, end, **tables, target=name, progress=f"{name}_progress")
            since = end
        return plain(materialize(sources.read_table(spark, name)))


@query
def silver_energy(spark, sf_dir):
    return plain(silver.build_energy(feeds.power_bronze(spark, sf_dir), feeds.carbon_bronze(spark, sf_dir)))


@query
def silver_weather_latest(spark, sf_dir):
    return plain(silver.latest_weather(silver.build_weather(feeds.weather_bronze(spark, sf_dir))))


@query
def dedup_latest(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    return plain(op.latest_per_key(df, ["user_id", "hour"], ["ts", "event_id"]))


@query
def join_feeds(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))

    def feed(kind: str, name: str) -> DataFrame:
        mine = df.filter(F.col("event_type") == kind).select("user_id", "hour", "ts", "event_id", "value")
        latest = op.latest_per_key(mine, ["user_id", "hour"], ["ts", "event_id"])
        return latest.select("user_id", "hour", F.col("event_id").alias(f"{name}_id"), F.col("value").alias(f"{name}_value"))

    return plain(feed("click", "click").join(feed("view", "view"), ["user_id", "hour"], "inner"))


# --- merges ----------------------------------------------------------------------

def _order_book(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Open and filled orders as the table; open and pending ones, repriced, as the batch."""
    book = orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = book.filter(F.col("o_orderstatus") != "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return book.filter(F.col("o_orderstatus") != "P"), batch


@query
def upsert_orders(spark, sf_dir):
    target, batch = _order_book(spark, sf_dir)
    return op.upsert(target, batch, ["o_orderkey"])


@query
def insert_only_orders(spark, sf_dir):
    target, batch = _order_book(spark, sf_dir)
    return op.insert_new(target, batch, ["o_orderkey"])


# --- ranges -----------------------------------------------------------------------

@query
def lookback_events(spark, sf_dir):
    return plain(op.lookback(events(spark, sf_dir), "ts", 48, LOOKBACK_END))


@query
def lookback_now(spark, sf_dir):
    """Events moved so that the last one happens now."""
    df = events(spark, sf_dir)
    moved = df.withColumn("ts", F.current_timestamp() + (F.col("ts") - df.agg(F.max("ts")).scalar()))
    return op.lookback(moved, "ts", 48).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def anchored_lookback(spark, sf_dir):
    return plain(op.anchored_lookback(events(spark, sf_dir), "ts", 12, extra_hours=24))


@query
def observed_forecast_split(spark, sf_dir):
    seen, ahead = op.split_observed_forecast(
        feeds.weather(spark, sf_dir).withColumn("vintage", fx.round_to_hour("ingested_at")), "datetime", "vintage"
    )
    marked = seen.withColumn("part", F.lit("observed")).unionByName(ahead.withColumn("part", F.lit("forecast")))
    return plain(marked.groupBy("vintage", "part").agg(F.count(F.lit(1)).alias("n"), F.max("datetime").alias("last")))


@query
def forecast_offset_horizon(spark, sf_dir):
    df = feeds.weather(spark, sf_dir).select(
        "name", "datetime", "ingested_at", fx.forecast_offset("datetime", "ingested_at").alias("forecast_offset_h")
    )
    return plain(op.horizon(df, 18))


# --- time ---------------------------------------------------------------------------

@query
def parse_utc_text(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    cut = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(text)
    return plain(events(spark, sf_dir).select("event_id", fx.parse_utc(cut).alias("parsed")))


@query
def local_to_utc(spark, sf_dir):
    hour = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    local = F.date_format(F.col("o_orderdate") + hour, "yyyy-MM-dd'T'HH:mm:ss")
    return plain(orders(spark, sf_dir).select("o_orderkey", fx.local_to_utc(local, "EET").alias("utc")))


@query
def round_hour(spark, sf_dir):
    df = events(spark, sf_dir)
    return plain(df.select(
        "event_id", fx.round_to_hour("ts").alias("nearest"), F.date_trunc("hour", "ts").alias("truncated")
    ))


@query
def calendar(spark, sf_dir):
    df = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return plain(fx.calendar_features(df, "o_orderdate"))


@query
def distinct_hours(spark, sf_dir):
    return plain(gold.vintages(events(spark, sf_dir).withColumnRenamed("ts", "ingested_at")))


# --- columns and missing values --------------------------------------------------------

@query
def numeric_features(spark, sf_dir):
    df = feeds.load(spark, sf_dir, "lineitem")
    named = fx.feature_columns(df, ("l_quantity", "l_discount", "l_tax", "l_ship", "l_line", "l_return"))
    return df.select("l_orderkey", *fx.numeric_columns(df, named))


def _sparse_orders(spark, sf_dir) -> DataFrame:
    urgent = orders(spark, sf_dir).filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", F.col("o_totalprice").alias("urgent_price"), F.lit(True).alias("is_urgent")
    )
    return orders(spark, sf_dir).select("o_orderkey", "o_custkey").join(urgent, "o_orderkey", "left")


@query
def null_fill(spark, sf_dir):
    return fx.fill_numeric(_sparse_orders(spark, sf_dir))


@query
def null_drop(spark, sf_dir):
    price = F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("urgent_price"))
    return fx.drop_incomplete(_sparse_orders(spark, sf_dir).withColumn("urgent_price", price))


# --- pivot, windows, set operations ------------------------------------------------------

@query
def pivot_measures(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts")).withColumn("k", feeds.prop_k())
    return plain(op.pivot_measures(df, ["hour"], "event_type", EVENT_TYPES[:3], ["value", "k"], ["ts", "event_id"]))


def _user_series(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "ts", "event_id", "value", feeds.prop_k().alias("k"))


@query
def lag_rolling(spark, sf_dir):
    made = op.lag_rolling_features(_user_series(spark, sf_dir), ["value", "k"], ["user_id"], ["ts", "event_id"])
    return plain(made, ("rolling_avg_",))


@query
def lag_rolling_sliced(spark, sf_dir):
    made = op.lag_rolling_features(
        _user_series(spark, sf_dir), ["value", "k"], ["user_id"], ["ts", "event_id"], hot_options=SMALL_SLICES
    )
    return plain(made, ("rolling_avg_",))


def _gappy_series(spark, sf_dir, **options) -> DataFrame:
    """Hours with little activity are missing from the energy series."""
    df = feeds.energy(spark, sf_dir).select("zone", "datetime", "carbon_intensity", "production_total")
    made = op.time_range_features(df, ["carbon_intensity", "production_total"], ["zone"], "datetime", (1, 24), **options)
    return plain(made, ("rolling_avg_",))


@query
def lag_rolling_by_time(spark, sf_dir):
    return _gappy_series(spark, sf_dir)


@query
def lag_rolling_by_time_sliced(spark, sf_dir):
    return _gappy_series(spark, sf_dir, hot_options={"min_rows": 5, "slice_rows": 10})


@query
def latest_snapshot(spark, sf_dir):
    return plain(op.latest_snapshot(orders(spark, sf_dir), "o_orderdate"))


@query
def union_by_name(spark, sf_dir):
    book = orders(spark, sf_dir)
    filled = book.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", "o_orderstatus")
    rest = book.filter(F.col("o_orderstatus") != "F").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return filled.unionByName(rest)


# --- feature tables -----------------------------------------------------------------------

def _silver(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Clean energy and weather tables, written out between the stages as the jobs do."""
    return materialize(feeds.energy(spark, sf_dir)), materialize(feeds.weather(spark, sf_dir))


def _gold_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """History and forecast tables, written out too."""
    energy, weather = _silver(spark, sf_dir)
    historic = gold.build_historic(energy, weather)
    return materialize(historic), materialize(gold.build_forecasts(weather, gold.vintages(energy)))


@query
def historic_gold(spark, sf_dir):
    return plain(gold.build_historic(*_silver(spark, sf_dir)), ("rolling_avg_",))


@query
def historic_gold_batch(spark, sf_dir):
    return plain(gold.build_historic(*_silver(spark, sf_dir), feature_scope="batch"), ("rolling_avg_",))


@query
def bronze_to_gold(spark, sf_dir):
    energy = materialize(silver.build_energy(feeds.power_bronze(spark, sf_dir), feeds.carbon_bronze(spark, sf_dir)))
    weather = materialize(silver.build_weather(feeds.weather_bronze(spark, sf_dir)))
    return plain(gold.build_historic(energy, weather), ("rolling_avg_",))


def _merged_gold(spark, energies, weather, lookback_days) -> DataFrame:
    """The history table after merging what each of ``energies`` and its weather deliver, looking back so many days."""
    with _scratch_table(spark) as name:
        for energy, near, days in zip(energies, weather, lookback_days):
            jobs.merge_historic(spark, name, materialize(energy), materialize(near), 24 * days)
        return plain(materialize(sources.read_table(spark, name)), ("rolling_avg_",))


@query
def gold_incremental(spark, sf_dir):
    """Three merges, each with what was delivered up to a day, equal one full build."""
    ends = ["2024-01-20", "2024-01-25", "2100-01-01"]
    return _merged_gold(spark, *(
        [feed(spark, sf_dir).filter(F.col("ingested_at") < F.lit(end).cast("timestamp")) for end in ends]
        for feed in (feeds.energy, feeds.weather)
    ), (400, 12, 12))


def without_weather(weather: DataFrame) -> DataFrame:
    """Weather without what was delivered on one late day."""
    return weather.filter(F.to_date("ingested_at") != F.lit("2024-01-28").cast("date"))


@query
def gold_incremental_missing_weather(spark, sf_dir):
    """Hours that are delivered again without weather leave the table, and so do their parts of later windows."""
    energies = [feeds.energy(spark, sf_dir, lag=0), feeds.energy(spark, sf_dir)]
    return _merged_gold(spark, energies, [feeds.weather(spark, sf_dir), without_weather(feeds.weather(spark, sf_dir))], (400, 400))


@query
def forecast_gold(spark, sf_dir):
    energy, weather = _silver(spark, sf_dir)
    return plain(gold.build_forecasts(weather, gold.vintages(energy)))


@query
def training_rows(spark, sf_dir):
    return plain(training.build_training(*_gold_tables(spark, sf_dir)), ("rolling_avg_",))


@query
def training_after_corrections(spark, sf_dir):
    """Training rows of wrong, missing and early values, then of what corrected them weeks later: equal to a full build.

    At first two zones have wrong values on three days, one lacks a day, one has a day's first deliveries, and one day's
    weather has not come.
    """
    true, weather = materialize(feeds.energy(spark, sf_dir)), materialize(feeds.weather(spark, sf_dir))
    day = F.to_date("datetime")
    wrong = F.col("zone").isin("click", "view") & day.between("2024-01-10", "2024-01-12")
    lacking = (F.col("zone") == "error") & (day == "2024-01-15")
    early = (F.col("zone") == "purchase") & (day == "2024-01-20")
    first = true.filter(~lacking & ~early).withColumn(
        "carbon_intensity", F.when(wrong, F.col("carbon_intensity") + 5).otherwise(F.col("carbon_intensity"))
    ).unionByName(feeds.energy(spark, sf_dir, lag=0).filter(early))
    early_weather = weather.filter(F.to_date("ingested_at") != F.lit("2024-01-18").cast("date"))
    with _scratch_table(spark) as name:
        historic, forecasts, log = f"{name}_historic", f"{name}_forecasts", f"{name}_changes"
        for energy, near in ((first, early_weather), (true, weather), (true, weather)):
            energy = materialize(energy)
            jobs.merge_historic(spark, historic, energy, near, 24 * 400, jobs.log_history(spark, log))
            ahead = gold.build_forecasts(near, gold.vintages(energy))
            sources.upsert_table(spark, forecasts, ahead, gold.FORECAST_KEYS, on_change=jobs.log_forecasts(spark, log))
            if sources.table_exists(spark, name):
                jobs.refresh_training(spark, historic, forecasts, name, log)
            else:
                rows = training.build_training(*[sources.read_table(spark, t) for t in (historic, forecasts)])
                sources.upsert_table(spark, name, rows, training.TRAINING_KEYS)
        return plain(materialize(sources.read_table(spark, name)), ("rolling_avg_",))


@query
def training_rows_lookback(spark, sf_dir):
    rows = training.build_training(*_gold_tables(spark, sf_dir), lookback_hours=96)
    return plain(rows.select("zone", gold.VINTAGE, "datetime", "target_val"))


@query
def chrono_split(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    parts = training.chrono_split(df, "hour", 0.8, accuracy=1_000_000)
    marked = parts[0].withColumn("is_train", F.lit(True)).unionByName(parts[1].withColumn("is_train", F.lit(False)))
    return plain(marked.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n"), F.min("hour").alias("first"), F.max("hour").alias("last")
    ))


# --- models ---------------------------------------------------------------------------------

def _backtest(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """History up to the last delivery that has history at its own hour, and all forecasts."""
    historic, forecasts = _gold_tables(spark, sf_dir)
    last = historic.join(
        historic.select(F.col(gold.VINTAGE).alias("datetime")).distinct(), "datetime", "left_semi"
    ).agg(F.max("datetime")).scalar()
    return historic.filter(F.col("datetime") <= last), forecasts


@query
def scoring_rows(spark, sf_dir):
    return plain(build_scoring(*_backtest(spark, sf_dir)), ("rolling_avg_",))


@query
def scoring_rows_per_group(spark, sf_dir):
    rows = build_scoring(*_backtest(spark, sf_dir), anchor="group")
    return plain(rows.select("zone", gold.VINTAGE, "datetime", "forecast_offset_h", "lag_carbon_intensity_0h"))


def _naive(spark, sf_dir, hours: int = 1) -> tuple[DataFrame, DataFrame]:
    """Each hour's intensity as the prediction for the next ``hours``, and the actual hours."""
    actual = feeds.energy(spark, sf_dir).select("zone", "datetime", "carbon_intensity")
    ahead = actual.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(hours))))
    predicted = ahead.select(
        "zone", F.col("datetime").alias(gold.VINTAGE), feeds.plus_hours(F.col("datetime"), F.col("ahead")).alias("datetime"),
        F.col("carbon_intensity").cast("double").alias("prediction"),
        F.col("datetime").alias("prediction_ingested_at"), F.lit("naive").alias("model_version"),
    )
    return predicted, actual


@query
def evaluate_rmse_r2(spark, sf_dir):
    rows = match_actuals(*_naive(spark, sf_dir))
    measured = gbt.evaluate(rows, "actual", by=["zone"])
    return measured.select("zone", "n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query
def monitor_rmse(spark, sf_dir):
    report = monitor(*_naive(spark, sf_dir))
    return plain(report, ("rmse", "mae", "bias"))


@query
def monitor_by_offset(spark, sf_dir):
    return plain(monitor(*_naive(spark, sf_dir, 24), by_offset=True), ("rmse", "mae", "bias"))


@query
def monitor_incremental(spark, sf_dir):
    """Sums of errors kept per day: late predictions, wrong and missing actual hours put right, a run without news; equal to a full report."""
    predicted, _ = _naive(spark, sf_dir, 24)
    true = feeds.energy(spark, sf_dir).select(
        "zone", "datetime", F.date_trunc("hour", "ingested_at").alias(gold.VINTAGE), "carbon_intensity"
    )
    predicted, true = materialize(predicted), materialize(true)
    day = F.to_date("datetime")
    wrong = F.col("zone").isin("click", "view") & day.between("2024-01-10", "2024-01-12")
    lacking = (F.col("zone") == "error") & (day == "2024-01-15")
    early = true.filter(~lacking).withColumn(
        "carbon_intensity", F.when(wrong, F.col("carbon_intensity") + 5).otherwise(F.col("carbon_intensity"))
    )
    late = F.col("prediction_ingested_at") >= F.lit("2024-01-20").cast("timestamp")
    with _scratch_table(spark) as name:
        predictions, historic, log, progress = (f"{name}_{k}" for k in ("predictions", "historic", "log", "progress"))
        for actual, new in ((early, predicted.filter(~late)), (true, predicted.filter(late)), (true, predicted.limit(0))):
            sources.upsert_table(spark, historic, actual, gold.HISTORIC_KEYS, on_change=jobs.log_history(spark, log))
            sources.append_table(new, predictions, "datetime")
            jobs.refresh_errors(spark, predictions, historic, name, log, progress)
        sums = materialize(sources.read_table(spark, name))
    return plain(quality_report(sums, by_offset=True), ("rmse", "mae", "bias"))


@query
def monitor_alarms(spark, sf_dir):
    return plain(change_alarms(error_sums(*_naive(spark, sf_dir, 24)), limit=2.0), ("rmse", "z", "cusum"))


@query
def gbt_fit_score(spark, sf_dir):
    """The whole fit: what went in, what came out."""
    rows = materialize(training.build_training(*_gold_tables(spark, sf_dir)))
    train, test = training.chrono_split(rows)
    model = gbt.fit_gbt(train)
    trees = model.stages[-1]
    return gbt.evaluate(model.transform(test)).select(
        F.lit(train.count()).cast("long").alias("n_train"), F.col("n").alias("n_test"),
        F.lit(len(model.stages[0].getInputCols())).alias("n_features"), F.lit(trees.getNumTrees).alias("n_trees"),
        (F.col("rmse") > 0).alias("has_rmse"),
    )


@query
def gbt_best_split(spark, sf_dir):
    """One tree of depth 1: the two means of the best split."""
    df = fx.calendar_features(events(spark, sf_dir), "ts").select("hour_of_day", "day_of_week", F.col("value").alias("y"))
    model = gbt.fit_gbt(df, ["hour_of_day", "day_of_week"], "y", trees=1, depth=1)
    made = model.transform(df).groupBy(F.round("prediction", 6).alias("prediction"))
    return made.agg(F.count(F.lit(1)).alias("n"))


@query
def score_latest(spark, sf_dir):
    historic, forecasts = _backtest(spark, sf_dir)
    model = gbt.fit_gbt(materialize(training.build_training(historic, forecasts)))
    stamped = score(model, build_scoring(historic, forecasts), 1, stamped_at=LOOKBACK_END)
    return plain(stamped.withColumn("prediction", F.col("prediction").isNotNull()))


@query
def model_versions(spark, sf_dir):
    """Two versions saved, the latest loaded: its predictions are those of the model that was saved."""
    df = fx.calendar_features(events(spark, sf_dir), "ts").select("event_id", "hour_of_day", "day_of_week", F.col("value").alias("y"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4()}"
    with _scratch_table(spark) as name:
        for trees in (1, 3):
            model = gbt.fit_gbt(df, ["hour_of_day", "day_of_week"], "y", trees=trees)
            gbt.save_model(spark, model, folder, gbt.evaluate(model.transform(df), "y"), name)
        loaded, version = gbt.load_latest(spark, name)
        versions = sources.read_table(spark, name).count()
    same = model.transform(df).select("event_id", "prediction").intersectAll(loaded.transform(df).select("event_id", "prediction"))
    return same.agg(F.count(F.lit(1)).alias("n_same")).select(
        F.lit(version).alias("version"), F.lit(versions).cast("long").alias("n_versions"),
        F.lit(loaded.stages[-1].getNumTrees).alias("n_trees"), "n_same",
    )
