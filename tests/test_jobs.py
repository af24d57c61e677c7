"""The jobs from landed payload files to monitored predictions."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridtide import schemas as S
from gridtide.model.gbt import evaluate, fit_gbt, load_latest, model_features, rmse_r2, save_model
from gridtide.operators import lookback
from gridtide.plans import jobs
from gridtide.plans.gold import build_forecasts, build_historic, vintages
from gridtide.plans.training import build_training
from gridtide.session import ensure_checkpoint_dir
from gridtide.sources import read_table, upsert_table, insert_new_table
from gridtide.streaming.ingest import stream_json
from tests import payloads


def ingest(spark, base, run, zones=("GR",)):
    folders = payloads.land(str(base), run, zones)
    jobs.run_ingest(spark, folders["power"], folders["carbon"], folders["weather"], payloads.run_time(run))


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


def test_everything_end_to_end(spark, clean_tables, tmp_path):
    zones = ("GR", "XX")
    for run in range(11):
        ingest(spark, tmp_path, run, zones)
    bronze = read_table(spark, S.BRONZE_WEATHER)
    assert bronze.columns == ["location_name", "raw_csv", "ingested_at"]
    assert bronze.count() == 44 and bronze.select("location_name").distinct().count() == 4

    at = payloads.run_time(10)
    jobs.run_silver(spark, 48, at)
    energy = read_table(spark, S.SILVER_ENERGY)
    assert energy.columns == list(S.ENERGY_COLUMNS) and len(energy.columns) == 37
    assert energy.count() == 2 * (24 + 30)
    # the hour of run 0 was last delivered by run 7
    hour0 = energy.filter((F.col("datetime") == payloads.START) & (F.col("zone") == "GR")).first()
    assert hour0.ingested_at == payloads.run_time(7) and hour0.isEstimated_power is False
    assert hour0.production_nuclear is None
    weather = read_table(spark, S.SILVER_WEATHER)
    assert len(weather.columns) == 13 and weather.count() == 11 * 4 * 96

    jobs.run_gold(spark, 48)
    historic, forecasts = read_table(spark, S.GOLD_HISTORIC), read_table(spark, S.GOLD_FORECASTS)
    assert (len(historic.columns), len(forecasts.columns)) == (219, 24)
    assert rows(rounded(historic)) == rows(rounded(build_historic(energy, weather)))

    # three more runs, merged with the default 12 hours: as if all had been built at once
    for run in range(11, 14):
        ingest(spark, tmp_path, run, zones)
    jobs.run_silver(spark, 12, payloads.run_time(13))
    jobs.run_gold(spark, 12)
    energy, weather = read_table(spark, S.SILVER_ENERGY), read_table(spark, S.SILVER_WEATHER)
    historic, forecasts = read_table(spark, S.GOLD_HISTORIC), read_table(spark, S.GOLD_FORECASTS)
    full = rows(rounded(build_historic(energy, weather)))
    assert rows(rounded(historic)) == full

    # again: nothing changes
    before = rows(forecasts)
    jobs.run_silver(spark, 12, payloads.run_time(13))
    jobs.run_gold(spark, 12)
    assert read_table(spark, S.SILVER_WEATHER).count() == 14 * 4 * 96
    assert rows(rounded(read_table(spark, S.GOLD_HISTORIC))) == full
    assert rows(read_table(spark, S.GOLD_FORECASTS)) == before

    jobs.run_training_rows(spark)
    training = read_table(spark, S.GOLD_TRAINING)
    assert len(training.columns) == 187  # the zone, and the 186 of a single zone
    per_hour = {(r[0], r[1]): r[2] for r in training.groupBy("zone", "ingested_hour_utc").count().collect()}
    # hours that still are the latest ingestion of some row and lie a day back: runs 2 … 5 of 13
    assert set(per_hour.values()) == {24} and {z for z, _ in per_hour} == set(zones)
    assert max(h for _, h in per_hour) == payloads.START + dt.timedelta(hours=15)
    assert rows(training) == rows(build_training(historic, forecasts, lookback_hours=48))

    folder = str(tmp_path / "models")
    assert jobs.run_train(spark, folder, trees=3) == 1
    assert jobs.run_train(spark, folder, trees=3) == 2
    models = read_table(spark, S.GOLD_MODELS).orderBy("version").collect()
    assert [m.version for m in models] == [1, 2] and models[0].rmse == models[1].rmse
    model, version = load_latest(spark)
    features = model_features(training)
    assert version == 2 and len(features) == 183 and model.stages[0].getInputCols() == features
    rmse, _ = rmse_r2(model.transform(training))
    assert rmse > 0

    jobs.run_score(spark)
    predictions = read_table(spark, S.GOLD_PREDICTIONS)
    assert predictions.columns[:5] == [
        "ingested_hour_utc", "datetime", "prediction", "prediction_ingested_at", "model_version"
    ]
    anchor = payloads.START + dt.timedelta(hours=39)
    assert predictions.count() == 48
    assert {(r.ingested_hour_utc, r.model_version) for r in predictions.collect()} == {(anchor, "2")}
    jobs.run_score(spark)
    assert read_table(spark, S.GOLD_PREDICTIONS).count() == 96

    # actuals for the next three hours arrive
    ingest(spark, tmp_path, 14, zones)
    jobs.run_silver(spark, 12, payloads.run_time(14))
    jobs.run_gold(spark, 12)
    energy, weather = read_table(spark, S.SILVER_ENERGY), read_table(spark, S.SILVER_WEATHER)
    assert rows(rounded(read_table(spark, S.GOLD_HISTORIC))) == rows(rounded(build_historic(energy, weather)))
    report = jobs.run_monitor(spark)
    assert sum(r.n for r in report.collect()) == 6  # each prediction once, however often it was stored
    assert sum(r.n for r in jobs.run_monitor(spark, by_offset=True).collect()) == 6


def test_batch_scope_equals_history_scope_within_one_batch(spark, clean_tables, tmp_path):
    ingest(spark, tmp_path, 0)
    jobs.run_silver(spark, 12, payloads.run_time(0))
    energy, weather = read_table(spark, S.SILVER_ENERGY), read_table(spark, S.SILVER_WEATHER)
    a, b = (build_historic(energy, weather, feature_scope=s) for s in ("history", "batch"))
    assert a.count() == 24 and rows(rounded(a)) == rows(rounded(b))
    # cut into slices, too
    cut = build_historic(energy, weather, hot_options={"min_rows": 2, "slice_rows": 5})
    assert cut.columns == a.columns and rows(rounded(cut)) == rows(rounded(a))
    jobs.run_gold(spark, 12, feature_scope="batch")
    assert rows(rounded(read_table(spark, S.GOLD_HISTORIC))) == rows(rounded(b))
    unfilled = build_historic(energy, weather, fill=None).first()
    assert unfilled.lag_production_nuclear_0h is None and a.first().lag_production_nuclear_0h == 0
    assert build_forecasts(weather, vintages(energy)).count() == build_forecasts(weather).count()


def test_rows_before_a_change_are_found_near_or_far(spark):
    hour = dt.timedelta(hours=1)
    first = payloads.START + 2000 * hour

    def at(zone, back):
        t = first - back * hour
        return (zone, t, t)

    ddl = "zone string, datetime timestamp, ingested_at timestamp"
    dense = [at("a", b) for b in range(-2, 60)]
    gaps = [at("b", b) for b in (-1, 3, 9, 900, 1500)]

    def starts(data):
        energy = spark.createDataFrame(data, ddl)
        firsts = energy.filter(F.col("datetime") >= first.replace(tzinfo=dt.timezone.utc)).groupBy("zone").agg(F.min("datetime").alias("first"))
        found = jobs.filling_starts(energy, energy.drop("zone"), firsts)
        return {r.zone: (first - r.start) // hour for r in found.collect()}

    assert starts(dense) == {"a": 23}
    # a zone with gaps goes back as far as it must, the others do not
    assert starts(dense + gaps) == {"a": 23, "b": 1500}
    assert starts(dense + [at("new", -3)]) == {"a": 23, "new": -3}


def test_landing_a_folder_again_adds_only_what_is_new(spark, clean_tables, tmp_path):
    for run in (0, 0, 1, 1):
        folder = tmp_path / "all"
        folder.mkdir(exist_ok=True)
        (folder / f"{run}.json").write_text(payloads.power("GR", run)) if not (folder / f"{run}.json").exists() else None
        jobs.run_ingest(spark, power_path=str(folder), ingested_at=payloads.run_time(run))
    stream_json(spark, str(folder), "power_data", S.BRONZE_POWER, str(tmp_path / "cp")).awaitTermination()
    bronze = read_table(spark, S.BRONZE_POWER)
    assert bronze.columns == ["source", "raw_json", "ingested_at"]
    assert {(r.raw_json, r.ingested_at) for r in bronze.collect()} == {
        (payloads.power("GR", run), payloads.run_time(run)) for run in (0, 1)
    } and bronze.count() == 2
    # only the days of the window are read
    plan = lookback(read_table(spark, S.BRONZE_POWER, with_day=True), "ingested_at", 12, payloads.run_time(1))
    assert "PartitionFilters: [isnotnull(_day" in plan._jdf.queryExecution().executedPlan().toString()


def test_lines_without_a_time_do_not_pile_up(spark, clean_tables, tmp_path):
    folder = payloads.land(str(tmp_path), 0)["weather"]
    with open(f"{folder}/location_name=Athens, Greece/payload.csv", "a") as f:
        f.write('"Athens, Greece",38.0,23.7,no time,1,1,1,1,1,1,1,"S1"\r\n')
    jobs.run_ingest(spark, weather_path=folder, ingested_at=payloads.run_time(0))
    energy = payloads.land(str(tmp_path), 0)
    jobs.run_ingest(spark, energy["power"], energy["carbon"], ingested_at=payloads.run_time(0))
    for _ in range(3):
        jobs.run_silver(spark, 12, payloads.run_time(0))
    assert read_table(spark, S.SILVER_WEATHER).count() == 4 * 96


def test_hours_delivered_again_without_weather_leave_gold(spark, clean_tables, tmp_path):
    for run in range(4):
        folders = payloads.land(str(tmp_path), run)
        jobs.run_ingest(
            spark, folders["power"], folders["carbon"], None if run == 2 else folders["weather"], payloads.run_time(run)
        )
        jobs.run_silver(spark, 12, payloads.run_time(run))
        jobs.run_gold(spark, 3)
        energy, weather = read_table(spark, S.SILVER_ENERGY), read_table(spark, S.SILVER_WEATHER)
        assert rows(rounded(read_table(spark, S.GOLD_HISTORIC))) == rows(rounded(build_historic(energy, weather)))


def test_jobs_leave_nothing_in_the_checkpoint_folder(spark, clean_tables, tmp_path):
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    ingest(spark, tmp_path, 0)
    before = set(os.listdir(shared))
    jobs.run_silver(spark, 12, payloads.run_time(0))
    jobs.run_gold(spark, 12)
    jobs.run_training_rows(spark)
    assert set(os.listdir(shared)) == before


def test_a_failed_save_does_not_block_the_next(spark, clean_tables, tmp_path):
    df = spark.range(200).selectExpr("CAST(id % 7 AS double) AS a", "CAST(id % 3 AS double) AS y")
    model = fit_gbt(df, ["a"], "y", trees=1)
    bad = spark.range(1).selectExpr("raise_error('broken') AS rmse")
    good = evaluate(model.transform(df), "y")
    with pytest.raises(Exception, match="broken"):
        save_model(spark, model, str(tmp_path / "m"), bad)
    assert [save_model(spark, model, str(tmp_path / "m"), good) for _ in range(2)] == [1, 2]
    assert load_latest(spark)[1] == 2


# --- table layer -----------------------------------------------------------------

KEYS = ["k", "datetime"]
DDL = "k string, datetime timestamp, x int"


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour) if n else None


def test_upsert_table_touches_only_its_days(spark, clean_tables):
    name = S.SILVER_ENERGY
    first = [("a", day(1), 1), ("a", day(2), 2), ("b", day(2, 5), 3), ("a", None, 4)]
    upsert_table(spark, name, spark.createDataFrame(first, DDL), KEYS)
    files = {r[0] for r in spark.table(name).filter("_day <> '2024-01-02'").select(F.input_file_name()).distinct().collect()}
    source = spark.createDataFrame([("a", day(2), 20), ("c", day(3), 30)], DDL)
    for _ in range(2):
        upsert_table(spark, name, source, KEYS)
    assert rows(read_table(spark, name)) == rows(spark.createDataFrame(
        [("a", day(1), 1), ("a", day(2), 20), ("b", day(2, 5), 3), ("a", None, 4), ("c", day(3), 30)], DDL))
    left = {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    assert files <= left | {f for f in files if "2024-01-03" in f}
    # a NULL key never matches, and the rows of its partition stay
    upsert_table(spark, name, spark.createDataFrame([("a", None, 5)], DDL), KEYS)
    assert read_table(spark, name).filter("datetime IS NULL").count() == 2
    upsert_table(spark, name, spark.createDataFrame([], DDL), KEYS)
    assert read_table(spark, name).count() == 6


def test_insert_new_table(spark, clean_tables):
    name = S.SILVER_WEATHER
    insert_new_table(spark, name, spark.createDataFrame([("a", day(1), 1)], DDL), KEYS)
    source = spark.createDataFrame([("a", day(1), 9), ("b", day(1), 2)], DDL)
    for _ in range(2):
        insert_new_table(spark, name, source, KEYS)
    assert rows(read_table(spark, name)) == rows(spark.createDataFrame([("a", day(1), 1), ("b", day(1), 2)], DDL))


def test_no_training_rows_no_model(spark, clean_tables, tmp_path, recwarn):
    assert jobs.run_train(spark, str(tmp_path)) is None
    assert any("no training rows" in str(w.message) for w in recwarn)
