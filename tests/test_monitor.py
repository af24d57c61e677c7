"""Sums of errors kept per day, and the sequential test on them."""

from __future__ import annotations

import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridtide import sources
from gridtide.model.monitor import change_alarms, error_sums, monitor, quality_report
from gridtide.plans import jobs
from gridtide.plans.gold import HISTORIC_KEYS, VINTAGE

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)
NAMES = [f"gold.kept_{k}" for k in ("predictions", "historic", "errors", "log", "progress")]
PREDICTED = f"zone string, {VINTAGE} timestamp, datetime timestamp, prediction double, prediction_ingested_at timestamp, model_version string"
ACTUAL = f"zone string, datetime timestamp, {VINTAGE} timestamp, carbon_intensity bigint"


@pytest.fixture
def kept_tables(spark):
    def drop():
        for name in NAMES:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    spark.sql("CREATE SCHEMA IF NOT EXISTS gold")
    drop()
    yield
    drop()


def predicted(days, stamp=None, model="1", by=1.0):
    hours = [T0 + 24 * d * H + h * H for d in days for h in range(24)]
    return [("GR", t - H, t, 100.0 + by * t.hour, stamp or t - H, model) for t in hours]


def actual(days, value=100):
    return [("GR", T0 + 24 * d * H + h * H, T0 + 24 * d * H + h * H, value) for d in days for h in range(24)]


def store(spark, predictions, history):
    sources.append_table(spark.createDataFrame(predictions, PREDICTED), NAMES[0], "datetime")
    sources.upsert_table(
        spark, NAMES[1], spark.createDataFrame(history, ACTUAL), HISTORIC_KEYS, on_change=jobs.log_history(spark, NAMES[3])
    )


def refreshed(spark):
    """The kept sums after a refresh, and the days whose files are new."""
    before = files(spark)
    jobs.refresh_errors(spark, *NAMES)
    return sources.read_table(spark, NAMES[2]), {os.path.basename(os.path.dirname(f)).split("=")[1] for f in files(spark) ^ before}


def files(spark):
    return set(sources.fresh_table(spark, NAMES[2]).inputFiles()) if sources.table_exists(spark, NAMES[2]) else set()


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def full(spark):
    return error_sums(sources.read_table(spark, NAMES[0]), sources.read_table(spark, NAMES[1]))


def test_only_days_with_news_are_written_and_equal_a_full_build(spark, kept_tables):
    store(spark, predicted(range(10)), actual(range(8)))
    kept, _ = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and kept.agg(F.sum("n")).head()[0] == 8 * 24
    # a correction of an old day, predictions of two more days, actual values of one that had none; the day of the
    # last prediction taken is looked at again
    store(spark, predicted((10, 11)), actual((2,), 90) + actual((8,)))
    kept, days = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and kept.agg(F.sum("n")).head()[0] == 9 * 24
    assert "2024-01-03" in days and "2024-01-09" in days
    assert not days & {f"2024-01-0{d}" for d in (1, 2, 4, 5, 6, 7, 8)}
    # nothing new
    kept, days = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and not days & {f"2024-01-0{d}" for d in range(1, 10)}
    # hours that leave the history leave the sums
    gone = spark.createDataFrame([("GR", T0 + 24 * 8 * H)], "zone string, first timestamp")
    sources.replace_from(
        spark, NAMES[1], spark.createDataFrame([], ACTUAL), gone, "zone", "first", on_change=jobs.log_history(spark, NAMES[3])
    )
    kept, _ = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and kept.agg(F.sum("n")).head()[0] == 8 * 24
    # a second prediction of the same hours takes the place of the first; another model counts for itself
    again = predicted((1,), T0 + 24 * 40 * H, by=3.0) + predicted((1,), T0 + 24 * 40 * H, model="2")
    store(spark, again, actual((1,)))
    kept, days = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and kept.agg(F.sum("n")).head()[0] == 9 * 24
    assert "2024-01-02" in days and "2024-01-03" not in days
    assert rows(quality_report(kept, True)) == rows(monitor(*[sources.read_table(spark, n) for n in NAMES[:2]], by_offset=True))


def test_a_run_that_died_before_its_marks_is_repeated(spark, kept_tables, monkeypatch):
    store(spark, predicted(range(3)), actual(range(3)))
    refreshed(spark)
    store(spark, predicted((3,)), actual((0,), 80) + actual((3,)))
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "commit_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refreshed(spark)
    kept, _ = refreshed(spark)
    assert rows(kept) == rows(full(spark)) and kept.agg(F.sum("n")).head()[0] == 4 * 24


def test_sums_of_nothing_and_of_nulls(spark):
    none, past = spark.createDataFrame([], PREDICTED), spark.createDataFrame(actual((0,)), ACTUAL)
    assert error_sums(none, past).count() == 0 and change_alarms(error_sums(none, past)).count() == 0
    odd = spark.createDataFrame(
        [("GR", T0, T0 + H, None, T0, "1"), (None, T0, T0 + H, 1.0, T0, "1"), ("GR", T0, None, 1.0, T0, "1"), ("GR", T0, T0 + 2 * H, 103.0, T0, "1")],
        PREDICTED,
    )
    assert [(r.n, r.sum_error, r.forecast_offset_h) for r in error_sums(odd, past).collect()] == [(1, 3.0, 2)]


def test_alarms_follow_the_recursion(spark):
    rng = random.Random(3)
    sums, want = [], {}
    for model in ("flat", "rising", "equal"):
        rmse = [{"equal": 5.0, "flat": rng.gauss(10, 1), "rising": rng.gauss(10 + max(0, d - 20) * 0.4, 1)}[model] for d in range(40)]
        mean, dev = statistics.mean(rmse[:7]), statistics.stdev(rmse[:7])
        s = 0.0
        for d, x in enumerate(rmse):
            sums.append((model, dt.date(2024, 1, 1) + dt.timedelta(days=d), 0, 4, 0.0, 0.0, 4 * x * x))
            if d >= 7:
                s = max(0.0, s + ((x - mean) / dev if dev > 1e-9 else 0.0) - 0.5)
            want[model, sums[-1][1]] = s
    df = spark.createDataFrame(sums, "model_version string, day date, forecast_offset_h long, n long, sum_error double, sum_abs double, sum_square double")
    got = change_alarms(df).collect()
    assert len(got) == 120 and all(abs(r.cusum - want[r.model_version, r.day]) < 1e-6 and r.alarm == (r.cusum > 5) for r in got)
    assert any(r.alarm for r in got if r.model_version == "rising") and not any(r.alarm for r in got if r.model_version == "equal")
