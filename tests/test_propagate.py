"""Training rows follow late corrections of the feature tables."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from gridtide import operators as op
from gridtide import sources
from gridtide.plans import jobs
from gridtide.plans.gold import FORECAST_KEYS, HISTORIC_KEYS, VINTAGE
from gridtide.plans.propagate import CHANGES, Scope, concerned
from gridtide.plans.training import TRAINING_KEYS, build_training
from tests.test_training import FORECASTS, H, HISTORIC, T0, ahead, hours

NAMES = {k: f"gold.late_{k}" for k in ("historic", "forecasts", "training", "log")}
SINCE = "zone string, first timestamp"


@pytest.fixture
def late_tables(spark):
    def drop():
        for name in NAMES.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    spark.sql("CREATE SCHEMA IF NOT EXISTS gold")
    drop()
    yield
    drop()


def merge_history(spark, rows):
    sources.upsert_table(
        spark, NAMES["historic"], spark.createDataFrame(rows, HISTORIC), HISTORIC_KEYS, on_change=jobs.log_history(spark, NAMES["log"])
    )


def merge_forecasts(spark, rows):
    sources.upsert_table(
        spark, NAMES["forecasts"], spark.createDataFrame(rows, FORECASTS), FORECAST_KEYS, on_change=jobs.log_forecasts(spark, NAMES["log"])
    )


def refresh(spark):
    jobs.refresh_training(spark, *[NAMES[k] for k in ("historic", "forecasts", "training", "log")])


def full(spark):
    return build_training(*[sources.read_table(spark, NAMES[k]) for k in ("historic", "forecasts")])


def build(spark):
    sources.upsert_table(spark, NAMES["training"], full(spark), TRAINING_KEYS)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def files(spark):
    shown = sources.fresh_table(spark, NAMES["training"]).inputFiles()
    # One task names its files alike on all days.
    return {(f.split("_day=")[1][:10], os.path.basename(f)) for f in shown}


def test_changed_rows(spark):
    schema = "k string, v int, w double"
    before = spark.createDataFrame([("same", 1, 1.0), ("altered", 2, 2.0), ("gone", 3, None), (None, 4, 4.0)], schema)
    after = spark.createDataFrame([("same", 1, 1.0), ("altered", 2, None), ("new", 5, 5.0), (None, 9, 4.0)], schema)
    found = {tuple(r) for r in op.changed_rows(before, after, ["k"], ["v"]).collect()}
    assert found == {("altered", 2, 2), ("gone", 3, None), ("new", None, 5), (None, 4, 9)}
    assert op.changed_rows(before, before, ["k"], []).count() == 0


def test_concerned(spark):
    at = [T0 + n * H for n in range(60)]
    changes = spark.createDataFrame(
        [("historic", "z", at[30], at[31], at[31]), ("historic", "y", at[40], None, at[41]), ("historic", None, None, None, None),
         ("forecasts", None, None, at[50], at[50])],
        "source string, zone string, datetime timestamp, old_ingested_hour_utc timestamp, new_ingested_hour_utc timestamp",
    ).select(*CHANGES)
    whole, single = concerned(changes)
    # the first keeps its vintage; the second makes one; the last is of forecasts
    assert {r[0] for r in whole.collect()} == {at[41], at[50]}
    assert {tuple(r) for r in single.collect()} == {("z", at[n]) for n in range(6, 31)} | {("y", at[n]) for n in range(16, 41)}


def test_equals_a_full_build_after_any_corrections(spark, late_tables):
    rnd = random.Random(5)
    history = {(z, r[1]): r for z in ("y", "z") for r in hours(z, 0, 120)}
    merge_history(spark, [r for r in history.values() if r[1] != T0 + 50 * H])
    merge_forecasts(spark, [r for v in range(0, 96, 3) if v != 30 for r in ahead(v, range(1, 25))])
    build(spark)
    refresh(spark)
    assert rows(sources.read_table(spark, NAMES["training"])) == rows(full(spark)) != []
    # a hole is filled; old targets and features are corrected; an hour moves to another vintage; forecasts come late
    z = list(history.values())
    merge_history(spark, [r for r in z if r[1] == T0 + 50 * H])
    for r in rnd.sample(z, 4):
        merge_history(spark, [(*r[:3], r[3] + 1000, r[4], -1.0)])
    merge_history(spark, [(*history["y", T0 + 60 * H][:2], T0 + 63 * H, 1, None, 2.0)])
    refresh(spark)
    assert rows(sources.read_table(spark, NAMES["training"])) == rows(full(spark))
    merge_forecasts(spark, [*ahead(30, range(1, 25)), *[(*r[:2], None, r[3]) for r in ahead(9, [4])]])
    refresh(spark)
    assert rows(sources.read_table(spark, NAMES["training"])) == rows(full(spark))
    # both zones lose the vintages around an hour that leaves the table
    starts = spark.createDataFrame([("z", T0 + 110 * H)], SINCE)
    sources.replace_from(
        spark, NAMES["historic"], spark.createDataFrame([], HISTORIC), starts, "zone", "first",
        on_change=jobs.log_history(spark, NAMES["log"]),
    )
    before = sources.read_table(spark, NAMES["training"]).count()
    refresh(spark)
    got = sources.read_table(spark, NAMES["training"])
    assert rows(got) == rows(full(spark)) and got.count() < before
    assert spark.table(NAMES["log"]).count() == 0


def test_only_concerned_days_are_rewritten_and_a_repeat_changes_nothing(spark, late_tables):
    merge_history(spark, hours("z", 0, 24 * 12))
    merge_forecasts(spark, [r for v in range(0, 24 * 10, 6) for r in ahead(v, range(1, 25))])
    build(spark)
    refresh(spark)
    before = files(spark)
    refresh(spark)
    assert files(spark) == before
    merge_history(spark, hours("z", 24 * 4, 1))
    refresh(spark)
    assert files(spark) == before  # the same row again is no change
    merge_history(spark, [(*hours("z", 24 * 4 + 5, 1)[0][:3], -1, 0.0, 0.0)])
    refresh(spark)
    after = files(spark)
    assert rows(sources.read_table(spark, NAMES["training"])) == rows(full(spark))
    # the ingestion hours of 24 hours before the corrected one, and the day ahead of each
    assert {day for day, _ in before - after} == {"2024-03-04", "2024-03-05", "2024-03-06"}


def test_reading_near_the_scope_prunes_days(spark, late_tables):
    merge_history(spark, hours("z", 0, 24 * 12))
    vintage = spark.createDataFrame([(T0 + 30 * H,)], f"{VINTAGE} timestamp")
    scope = Scope(vintage, spark.createDataFrame([], f"zone string, {VINTAGE} timestamp"))
    near = scope.near(sources.read_table(spark, NAMES["historic"], with_day=True))
    assert {r[0].day for r in near.select(F.to_date("datetime")).distinct().collect()} == {2, 3}
    filters = near._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "_day" in filters and "IN" in filters
