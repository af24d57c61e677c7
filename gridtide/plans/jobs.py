"""Batch jobs: tables in, one table write out.

Order: ``run_ingest`` → ``run_silver`` → ``run_gold`` → ``run_training_rows``;
``run_train`` weekly, ``run_score`` and ``run_monitor`` after each gold run. A
scheduler of your choice calls them; each can be run again safely.
"""

from __future__ import annotations

import datetime as dt
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridtide import schemas as S
from gridtide.model.gbt import TREES, evaluate, fit_gbt, load_latest, save_model
from gridtide.model.monitor import change_alarms, error_sums, quality_report
from gridtide.model.scoring import build_scoring, score
from gridtide.operators import anchored_lookback, broadcast_if_small, changed_rows, from_time, lookback
from gridtide.plans.gold import (
    FORECAST_KEYS, HISTORIC_KEYS, VINTAGE, WINDOW_ROWS, build_forecasts, build_historic, feature_keys, vintages,
)
from gridtide.plans.propagate import CHANGES, Scope, concerned
from gridtide.plans.silver import ENERGY_KEYS, WEATHER_KEYS, build_energy, build_weather
from gridtide.plans.training import TRAINING_KEYS, build_training, chrono_split
from gridtide.schemas import DAY
from gridtide.session import materialize, scratch, staged, use_utc
from gridtide.sources import (
    append_table, commit_marks, ensure_schema, fresh_table, high_water, hours_since, insert_new_table, land_csv, land_json,
    land_table, marks, read_days_of, read_table, replace_from, replace_marked, table_exists, upsert_table,
)
from gridtide.sources.tables import OnChange

DEFAULT_LOOKBACK = 12
# A vintage has its targets only a day later, so a shorter window never yields rows.
TRAINING_LOOKBACK = 48
WEATHER_EXTRA_HOURS = 24
# Days searched first for the rows before a changed hour; each further search spans four times as many.
SEARCH_DAYS = 7
# Changed zones that are broadcast at most (some 30 bytes each).
SMALL_ZONES = 500_000
_DAY_MICROS = 86_400_000_000


def run_ingest(
    spark: SparkSession,
    power_path: str | None = None,
    carbon_path: str | None = None,
    weather_path: str | None = None,
    ingested_at: dt.datetime | None = None,
) -> None:
    """Append landed payload files to the bronze tables, each file once however often its folder is landed."""
    use_utc(spark)
    if power_path:
        land_table(land_json(spark, power_path, "power_data", ingested_at), S.BRONZE_POWER)
    if carbon_path:
        land_table(land_json(spark, carbon_path, "carbon_intensity", ingested_at), S.BRONZE_CARBON)
    if weather_path:
        land_table(land_csv(spark, weather_path, ingested_at), S.BRONZE_WEATHER)


def run_silver(
    spark: SparkSession,
    lookback_hours: int = DEFAULT_LOOKBACK,
    as_of: dt.datetime | None = None,
    tz: str = S.WEATHER_TIME_ZONE,
    header_lines: int = 1,
    strict: bool = False,
) -> None:
    """Merge recent bronze payloads into the clean tables.

    The window is the lookback, or reaches back to what the last run took if that is
    longer ago, so a pause loses nothing. The energy feeds are joined and share one window.
    """
    use_utc(spark)
    now = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    with scratch(spark):
        merge_energy(spark, lookback_hours, now, strict)
        (weather,), reached = catch_up(spark, [S.BRONZE_WEATHER], S.SILVER_WEATHER, lookback_hours, now)
        insert_new_table(spark, S.SILVER_WEATHER, build_weather(weather, tz, header_lines), WEATHER_KEYS)
        commit_marks(spark, reached)


def merge_energy(
    spark: SparkSession,
    lookback_hours: int,
    now: dt.datetime,
    strict: bool = False,
    power: str = S.BRONZE_POWER,
    carbon: str = S.BRONZE_CARBON,
    target: str = S.SILVER_ENERGY,
    progress: str = S.PROGRESS,
) -> None:
    """Merge both energy feeds as far as they have come since the last run, at least those of the lookback."""
    taken, reached = catch_up(spark, [power, carbon], target, lookback_hours, now, progress)
    upsert_table(spark, target, build_energy(*taken, strict), ENERGY_KEYS)
    commit_marks(spark, reached, progress)


def catch_up(
    spark: SparkSession, names: list[str], reader: str, lookback_hours: int, now: dt.datetime, progress: str = S.PROGRESS
) -> tuple[list[DataFrame], dict[str, dt.datetime | None]]:
    """(the rows of each table that ``reader`` is to take, the marks to commit when it has merged them).

    Rows of the last ``lookback_hours`` before ``now``, or from the lowest of the reader's marks on these
    tables if that is earlier; the row at a mark is taken again, as others may share its time. A reader
    without marks has the lookback alone. The rows are written out, so that what is
    merged is what the marks were taken from, also if payloads arrive meanwhile.
    """
    known = marks(spark, [f"{reader} from {n}" for n in names], progress)
    hours = max(lookback_hours, *[hours_since(at, now) for at in known.values()])
    taken = [materialize(lookback(read_table(spark, n, with_day=True), "ingested_at", hours, now)) for n in names]
    return taken, {r: high_water(df) for r, df in zip(known, taken)}


def changed_from(energy: DataFrame, lookback_hours: int) -> DataFrame:
    """(zone, first): the earliest hour of each zone that was delivered in the lookback window."""
    anchor = energy.agg(F.max(F.date_trunc("hour", "ingested_at")))
    recent = anchored_lookback(energy.select("zone", "datetime", "ingested_at"), "ingested_at", lookback_hours, anchor)
    return recent.groupBy("zone").agg(F.min("datetime").alias("first"))


def filling_starts(energy: DataFrame, weather: DataFrame, firsts: DataFrame) -> DataFrame:
    """(zone, first, start): where each zone has its ``WINDOW_ROWS - 1`` feature rows before ``first``.

    ``start`` is the hour of the earliest of them, or ``first`` if there are none.
    Hours are looked through backwards, in spans that grow fourfold and do not
    overlap, on narrow columns, and only for zones that lack rows still; a zone
    with gaps or a new zone so costs nothing to the others.
    """
    needed = WINDOW_ROWS - 1
    lowest = energy.agg(F.unix_micros(F.min("datetime"))).head()[0] or 0
    found = materialize(firsts.select("zone", "first", F.lit(0).cast("long").alias("n"), F.col("first").alias("start")))
    span, back = SEARCH_DAYS, 0
    keep = F.col("n") < needed
    while True:
        bounds = found.filter(keep).agg(F.unix_micros(F.min("first")), F.unix_micros(F.max("first"))).head()
        if bounds[0] is None or bounds[1] - back * _DAY_MICROS <= lowest:
            return found.select("zone", "first", "start")
        upper = F.timestamp_micros(F.lit(bounds[1] - back * _DAY_MICROS))
        lower = F.timestamp_micros(F.lit(bounds[0] - (back + span) * _DAY_MICROS))

        def near(df: DataFrame) -> DataFrame:
            kept = from_time(df, lower).filter(F.col("datetime") < upper)
            return kept.filter(F.col(DAY) <= F.to_date(upper)) if DAY in df.columns else kept

        short = found.filter(keep).select("zone", "first", "n")
        hours = (F.unix_micros("first") - F.unix_micros("datetime")) / _DAY_MICROS
        before = feature_keys(near(energy), near(weather)).join(broadcast_if_small(short, SMALL_ZONES), "zone").filter(
            (hours > back) & (hours <= back + span)
        )
        newest = Window.partitionBy("zone").orderBy(F.col("datetime").desc())
        ranked = before.withColumn("r", F.row_number().over(newest)).filter(F.col("r") + F.col("n") <= needed)
        more = ranked.groupBy("zone").agg(F.max("r").alias("more"), F.min("datetime").alias("earlier"))
        found = materialize(found.join(more, "zone", "left").select(
            "zone", "first", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
            F.coalesce("earlier", "start").alias("start"),
        ))
        back, span = back + span, 4 * span


def gold_inputs(energy: DataFrame, weather: DataFrame, lookback_hours: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(energy rows to build features from, their weather, starts) for features along each zone.

    A changed hour also enters the frames of the hours after it, so each zone is
    built again from its own first changed hour on, with its own feature rows
    before that as filling. ``starts`` is (zone, first, start), written out.
    """
    starts = filling_starts(energy, weather, materialize(changed_from(energy, lookback_hours)))
    lowest = starts.agg(F.unix_micros(F.min("start"))).head()[0] or 0
    since = F.timestamp_micros(F.lit(lowest))
    zones = broadcast_if_small(starts.select("zone", "start"), SMALL_ZONES)
    rows = from_time(energy, since).join(zones, "zone").filter(F.col("datetime") >= F.col("start")).drop("start")
    return rows, from_time(weather, since), starts


def merge_historic(
    spark: SparkSession, name: str, energy: DataFrame, weather: DataFrame, lookback_hours: int, on_change: OnChange | None = None
) -> None:
    """Bring the history table up to date with the deliveries of the lookback window.

    The rows of a zone from its first changed hour on are replaced, so the table
    equals a full rebuild: an hour whose newest delivery has no weather has no
    features and leaves the table.
    """
    rows, near, starts = gold_inputs(energy, weather, lookback_hours)
    made = build_historic(rows, near)
    firsts = broadcast_if_small(starts.select("zone", "first"), SMALL_ZONES)
    historic = made.join(firsts, "zone").filter(F.col("datetime") >= F.col("first")).select(*made.columns)
    replace_from(spark, name, historic, starts, "zone", "first", on_change=on_change)


def run_gold(spark: SparkSession, lookback_hours: int = DEFAULT_LOOKBACK, feature_scope: str = "history") -> None:
    """Merge feature rows and forecasts of the recent ingestion hours into the gold tables.

    In history scope (see ``merge_historic``) every zone is built again from its
    first changed hour on. In batch scope the recent rows are enough. The window is the
    lookback before the latest delivery, or reaches back to the latest one of the last run.
    """
    use_utc(spark)
    energy, weather = (read_table(spark, n, with_day=True) for n in (S.SILVER_ENERGY, S.SILVER_WEATHER))
    reader = f"{S.GOLD_HISTORIC} from {S.SILVER_ENERGY}"
    latest = high_water(energy)
    lookback_hours = max(lookback_hours, hours_since(marks(spark, [reader])[reader], latest))
    anchor = energy.agg(F.max(F.date_trunc("hour", "ingested_at")))
    recent = anchored_lookback(energy, "ingested_at", lookback_hours, anchor)
    ahead = anchored_lookback(weather, "ingested_at", lookback_hours, anchor, WEATHER_EXTRA_HOURS)
    with scratch(spark):
        if feature_scope == "batch":
            made = build_historic(recent, ahead, feature_scope="batch")
            upsert_table(spark, S.GOLD_HISTORIC, made, HISTORIC_KEYS, on_change=log_history(spark))
        else:
            merge_historic(spark, S.GOLD_HISTORIC, energy, weather, lookback_hours, log_history(spark))
        made = build_forecasts(ahead, vintages(recent))
        upsert_table(spark, S.GOLD_FORECASTS, made, FORECAST_KEYS, on_change=log_forecasts(spark))
    commit_marks(spark, {reader: latest})


def _log(spark: SparkSession, changes: DataFrame, *logs: str) -> None:
    """Append to each log as a batch of its own; a merge that dies after it logs the same again."""
    with staged(changes) as rows:
        if rows.isEmpty():
            return
        batched = rows.select(*CHANGES, F.lit(uuid.uuid4().hex).alias("batch"))
        for log in logs:
            ensure_schema(spark, log)
            batched.write.mode("append").format("parquet").partitionBy("batch").saveAsTable(log)


def _batches(spark: SparkSession, log: str) -> list[str]:
    """The batches that a log holds by now."""
    return sorted(r[0] for r in fresh_table(spark, log).select("batch").distinct().collect()) if table_exists(spark, log) else []


def log_history(spark: SparkSession, *logs: str) -> OnChange:
    """Writes down which history rows a merge adds, removes or alters, in one log for each reader (training and monitoring)."""
    def write(before: DataFrame, after: DataFrame) -> None:
        changed = changed_rows(before, after, HISTORIC_KEYS, [VINTAGE])
        _log(spark, changed.withColumn("source", F.lit("historic")), *(logs or (S.GOLD_CHANGES, S.GOLD_ERROR_CHANGES)))

    return write


def log_forecasts(spark: SparkSession, log: str = S.GOLD_CHANGES) -> OnChange:
    """Writes down which vintages have new or altered forecasts."""
    def write(before: DataFrame, after: DataFrame) -> None:
        kept = changed_rows(before, after, FORECAST_KEYS, []).select(VINTAGE).distinct()
        rows = kept.select(F.lit("forecasts").alias("source"), F.lit(None).cast("string").alias("zone"),
                           F.lit(None).cast("timestamp").alias("datetime"),
                           *[F.col(VINTAGE).alias(f"{side}_{VINTAGE}") for side in ("old", "new")])
        _log(spark, rows, log)

    return write


def refresh_training(
    spark: SparkSession,
    historic: str = S.GOLD_HISTORIC,
    forecasts: str = S.GOLD_FORECASTS,
    training: str = S.GOLD_TRAINING,
    log: str = S.GOLD_CHANGES,
) -> None:
    """Build the training rows again that logged changes concern, however long ago their hours are.

    Rows of these zones and ingestion hours are replaced, and deleted where the vintage is not complete any more;
    the result equals a full build. The batches taken are removed from the log last, so a run that dies
    is repeated by the next one.
    """
    batches = _batches(spark, log)
    if not batches:
        return
    with scratch(spark):
        changes = fresh_table(spark, log).filter(F.col("batch").isin(batches))
        scope = Scope(*[materialize(df) for df in concerned(changes)])
        rows = build_training(
            read_table(spark, historic, with_day=True), read_table(spark, forecasts, with_day=True), scope=scope
        )
        replace_marked(spark, training, rows, scope.days(), scope.marked)
    _forget(spark, log, batches)


def _forget(spark: SparkSession, log: str, batches: list[str]) -> None:
    for batch in batches:
        spark.sql(f"ALTER TABLE {log} DROP IF EXISTS PARTITION (batch = '{batch}')")


def run_training_rows(spark: SparkSession, lookback_hours: int | None = TRAINING_LOOKBACK) -> None:
    """Bring the training rows up to date with the feature tables.

    The first run, and one with None, builds the ingestion hours of the lookback (None: all). Later ones build what
    has changed since, of whatever age (see ``refresh_training``).
    """
    use_utc(spark)
    if table_exists(spark, S.GOLD_TRAINING) and lookback_hours is not None:
        refresh_training(spark)
        return
    batches = _batches(spark, S.GOLD_CHANGES)
    historic = read_table(spark, S.GOLD_HISTORIC, with_day=True)
    forecasts = read_table(spark, S.GOLD_FORECASTS, with_day=True)
    with scratch(spark):
        rows = build_training(historic, forecasts, lookback_hours=lookback_hours)
        upsert_table(spark, S.GOLD_TRAINING, rows, TRAINING_KEYS)
    if lookback_hours is None:
        refresh_training(spark)
    else:
        _forget(spark, S.GOLD_CHANGES, batches)


def run_train(spark: SparkSession, model_folder: str, trees: int = TREES) -> int | None:
    """Fit on the earlier part, evaluate on the later one, register; None without training rows."""
    use_utc(spark)
    if not table_exists(spark, S.GOLD_TRAINING) or read_table(spark, S.GOLD_TRAINING).isEmpty():
        warnings.warn("no training rows; nothing was fitted")
        return None
    train, test = chrono_split(read_table(spark, S.GOLD_TRAINING))
    model = fit_gbt(train, trees=trees)
    metrics = evaluate(model.transform(test)).select(
        F.lit(train.count()).cast("long").alias("train_size"), F.col("n").alias("test_size"), "rmse", "r2"
    )
    return save_model(spark, model, model_folder, metrics)


def run_score(spark: SparkSession, anchor: str = "global") -> None:
    """Append the predictions of the latest model for the hours ahead."""
    use_utc(spark)
    model, version = load_latest(spark)
    historic = read_table(spark, S.GOLD_HISTORIC, with_day=True)
    forecasts = read_table(spark, S.GOLD_FORECASTS, with_day=True)
    with staged(score(model, build_scoring(historic, forecasts, anchor=anchor), version)) as scored:
        if scored.isEmpty():
            warnings.warn("no forecasts of the latest hour; nothing was predicted")
        append_table(scored, S.GOLD_PREDICTIONS, "datetime")


def refresh_errors(
    spark: SparkSession,
    predictions: str = S.GOLD_PREDICTIONS,
    historic: str = S.GOLD_HISTORIC,
    errors: str = S.GOLD_ERRORS,
    log: str = S.GOLD_ERROR_CHANGES,
    progress: str = S.PROGRESS,
) -> None:
    """Bring the sums of errors up to date on the days that have new predictions or logged changes of history.

    The sums of these days replace the old ones, so the table equals a full build, also after late corrections and
    after rows that went. Other days are neither read nor written. The first run takes all days. The mark and the
    log move last, so a run that dies is repeated by the next one. Predictions are new if their time is not before
    the latest one taken so far.
    """
    reader = f"{errors} from {predictions}"
    at = marks(spark, [reader], progress)[reader] if table_exists(spark, errors) else None
    batches = _batches(spark, log)
    stored = read_table(spark, predictions, with_day=True)
    latest = high_water(stored, "prediction_ingested_at")
    with scratch(spark):
        if at is None:
            days = stored.select(DAY)
        else:
            micros = (at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            days = stored.filter(F.col("prediction_ingested_at") >= F.timestamp_micros(F.lit(micros))).select(DAY)
            if batches:
                changed = fresh_table(spark, log).filter(F.col("batch").isin(batches))
                days = days.unionByName(changed.select(F.to_date("datetime").alias(DAY)))
        days = materialize(days.distinct())
        touched = days.select(F.col(DAY).alias("datetime"))
        sums = error_sums(*[read_days_of(spark, name, touched) for name in (predictions, historic)])
        replace_marked(spark, errors, sums, days, lambda df, mark: df.withColumn(mark, F.lit(True)), "day")
    commit_marks(spark, {reader: latest}, progress)
    _forget(spark, log, batches)


def run_monitor(spark: SparkSession, by_offset: bool = False) -> DataFrame:
    """Quality of all predictions that have an actual value by now; replaces the report and the alarms.

    Both are made from sums that are kept per day, so a run reads the predictions of the days with news only.
    """
    use_utc(spark)
    refresh_errors(spark)
    sums = read_table(spark, S.GOLD_ERRORS)
    for made, name in ((quality_report(sums, by_offset), S.GOLD_MONITORING), (change_alarms(sums), S.GOLD_ALARMS)):
        made.write.mode("overwrite").format("parquet").saveAsTable(name)
    return read_table(spark, S.GOLD_MONITORING)
