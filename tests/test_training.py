"""Training rows, splits, scoring rows and monitoring on small fixtures."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridtide.model.gbt import evaluate
from gridtide.model.monitor import monitor
from gridtide.model.scoring import build_scoring
from gridtide.plans.gold import build_forecasts, build_historic
from gridtide.plans.silver import build_energy, latest_weather
from gridtide.plans.training import build_training, chrono_split, mark_split

H = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 3, 1)
HISTORIC = "zone string, datetime timestamp, ingested_hour_utc timestamp, carbon_intensity bigint, lag_a_0h double, rolling_avg_a_24h double"
FORECASTS = "ingested_hour_utc timestamp, datetime timestamp, temp_x double, forecast_offset_h bigint"


def frames(spark, historic, forecasts):
    return spark.createDataFrame(historic, HISTORIC), spark.createDataFrame(forecasts, FORECASTS)


def hours(zone, start, n, vintage=None):
    return [(zone, T0 + (start + i) * H, T0 + (start + i if vintage is None else vintage) * H, 100 + start + i, 1.0 * (start + i), 0.5) for i in range(n)]


def ahead(vintage, offsets):
    return [(T0 + vintage * H, T0 + (vintage + o) * H, 0.1 * o, o) for o in offsets]


def keys(df):
    return sorted((r.zone, (r.ingested_hour_utc - T0) // H, (r.datetime - T0) // H) for r in df.collect())


def test_complete_vintage(spark):
    df = build_training(*frames(spark, hours("z", 0, 40), ahead(5, range(0, 26))))
    assert df.columns == [
        "zone", "ingested_hour_utc", "datetime", "temp_x", "forecast_offset_h", "hour_of_day", "day_of_week", "month",
        "day_of_year", "week_of_year", "lag_a_0h", "rolling_avg_a_24h", "target_val",
    ]
    assert keys(df) == [("z", 5, 5 + o) for o in range(1, 25)]
    r = df.filter("forecast_offset_h = 3").first()
    # calendar of the target hour, features of the snapshot hour, target of the target hour
    assert (r.hour_of_day, r.lag_a_0h, r.target_val) == (8, 5.0, 108)


def test_one_missing_target_drops_the_vintage(spark):
    history = [r for r in hours("z", 0, 40) if r[1] != T0 + 20 * H] + hours("y", 0, 40)
    assert {k[0] for k in keys(build_training(*frames(spark, history, ahead(5, range(1, 25)))))} == {"y"}
    assert build_training(*frames(spark, hours("z", 0, 29), ahead(5, range(1, 25)))).count() == 0


def test_missing_or_incomplete_snapshot(spark):
    full = hours("z", 0, 40)
    gone = [r for r in full if r[1] != T0 + 5 * H]
    assert build_training(*frames(spark, gone, ahead(5, range(1, 4)))).count() == 0
    for bad in (None, float("nan")):
        broken = [(*r[:4], bad, r[5]) if r[1] == T0 + 5 * H else r for r in full]
        assert build_training(*frames(spark, broken, ahead(5, range(1, 4)))).count() == 0
    twice = full + [r for r in full if r[1] == T0 + 5 * H]
    assert build_training(*frames(spark, twice, ahead(5, range(1, 4)))).count() == 0


def test_repeated_target_hour_leaves_the_vintage_out(spark):
    full = hours("z", 0, 40) + hours("y", 0, 40)
    twice = full + [r for r in full if r[0] == "z" and r[1] == T0 + 7 * H]
    assert {k[0] for k in keys(build_training(*frames(spark, twice, ahead(5, range(1, 4)))))} == {"y"}


def test_incomplete_forecast_rows_leave_the_window(spark):
    rows = ahead(5, [1, 2, 3])
    rows[1] = (*rows[1][:2], None, 2)
    df = build_training(*frames(spark, hours("z", 0, 40), rows))
    assert [k[2] for k in keys(df)] == [6, 8]


def test_hours_that_no_row_was_ingested_at(spark):
    # all rows were last ingested at hour 30, so 5 is no ingestion hour any more
    assert build_training(*frames(spark, hours("z", 0, 40, vintage=30), ahead(5, [1]) + ahead(30, [1]))).count() == 1


def test_lookback(spark):
    args = frames(spark, hours("z", 0, 60), [x for v in range(0, 50, 3) for x in ahead(v, [1, 2])])
    assert {k[1] for k in keys(build_training(*args, lookback_hours=20))} == {39, 42, 45, 48}


def test_equals_an_hourly_loop(spark):
    rnd = random.Random(8)
    history = [r for z in "abc" for r in hours(z, 0, 90) if rnd.random() < 0.985]
    history = [(*r[:4], None if rnd.random() < 0.03 else r[4], r[5]) for r in history]
    forecasts = [x for v in range(0, 90, 3) for x in ahead(v, range(-3, 30)) if rnd.random() < 0.9]
    want = []
    for zone in "abc":
        mine = {r[1]: r for r in history if r[0] == zone}
        for h in sorted({r[2] for r in history}):
            window = [f for f in forecasts if f[0] == h and 0 < f[3] <= 24]
            if h in mine and mine[h][4] is not None and window and all(f[1] in mine for f in window):
                want += [(zone, (h - T0) // H, (f[1] - T0) // H) for f in window]
    assert want and keys(build_training(*frames(spark, history, forecasts))) == sorted(want)


def test_chrono_split_keeps_vintages_whole(spark):
    data = [(T0 + (i // 10) * H,) for i in range(100)]
    df = spark.createDataFrame(data, "ingested_hour_utc timestamp")
    train, test = chrono_split(df)
    assert (train.count(), test.count()) == (80, 20)
    assert train.intersect(test).count() == 0
    assert mark_split(df).filter("is_train").count() == 80


def test_scoring_rows(spark):
    history, forecasts = frames(spark, hours("z", 0, 10) + hours("late", 0, 8), ahead(9, range(0, 26)) + ahead(7, [1]))
    rows = build_scoring(history, forecasts)
    assert keys(rows) == [("z", 9, 9 + o) for o in range(1, 25)]
    assert keys(build_scoring(history, forecasts, anchor="group")) == [("late", 7, 8)] + keys(rows)
    assert build_scoring(history, forecasts.filter("ingested_hour_utc < '2024-03-01 09:00:00'")).count() == 0
    with pytest.raises(ValueError):
        build_scoring(history, forecasts, anchor="other")


def test_monitor(spark):
    predicted = [
        ("z", T0, T0 + h * H, p, T0 + at * H, "1") for h, p, at in [(1, 10.0, 1), (1, 12.0, 2), (2, 20.0, 1), (99, 5.0, 1)]
    ]
    p = spark.createDataFrame(predicted, "zone string, ingested_hour_utc timestamp, datetime timestamp, prediction double, prediction_ingested_at timestamp, model_version string")
    a = spark.createDataFrame([("z", T0 + H, 10), ("z", T0 + 2 * H, 24), ("z", T0 + 3 * H, None)], "zone string, datetime timestamp, carbon_intensity bigint")
    r = monitor(p, a).first()
    # the later of the two predictions for one hour counts; the one without an actual does not
    assert (r.n, round(r.rmse, 6), r.mae, r.bias, r.rmse_trailing, r.drift) == (2, round(10 ** 0.5, 6), 3.0, -1.0, None, False)
    assert sorted((x.forecast_offset_h, x.n) for x in monitor(p, a, by_offset=True).collect()) == [(1, 1), (2, 1)]


def test_monitor_flags_drift(spark):
    p = spark.createDataFrame(
        [("z", T0, T0 + d * 24 * H, float(e), T0, "1") for d, e in enumerate([1, 1, 1, 5])],
        "zone string, ingested_hour_utc timestamp, datetime timestamp, prediction double, prediction_ingested_at timestamp, model_version string",
    )
    a = p.select("zone", "datetime", F.lit(0).cast("bigint").alias("carbon_intensity"))
    assert [r.drift for r in monitor(p, a).orderBy("day").collect()] == [False, False, False, True]


def test_evaluate(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 5.0), (None, 9.0)], "target_val bigint, prediction double")
    r = evaluate(df).first()
    assert (r.n, round(r.rmse, 6), round(r.r2, 6)) == (3, round((4 / 3) ** 0.5, 6), -1.0)
    assert evaluate(df.limit(0)).first().n == 0


# --- feeds to tables -----------------------------------------------------------------

def test_energy_needs_both_feeds_and_takes_the_latest(spark):
    import json

    def payload(at, **hour):
        return ("s", json.dumps({"history": [{"zone": "z", "datetime": "2024-03-01T05:00:00.000Z", **hour}]}), T0 + at * H)

    ddl = "source string, raw_json string, ingested_at timestamp"
    power = spark.createDataFrame([payload(6, powerConsumptionTotal=1), payload(9, powerConsumptionTotal=2)], ddl)
    carbon = spark.createDataFrame([payload(7, carbonIntensity=300), payload(6, carbonIntensity=200)], ddl)
    r = build_energy(power, carbon).collect()
    assert len(r) == 1 and (r[0].consumption_total, r[0].carbon_intensity) == (2, 300)
    assert (r[0].ingested_at, r[0].ingested_at_carbon) == (T0 + 9 * H, T0 + 7 * H)
    assert build_energy(power, carbon.limit(0)).count() == 0


def weather(spark, rows):
    cols = "name string, datetime timestamp, ingested_at timestamp, temp double, humidity double, precip double, windspeed double, winddir double, cloudcover double, solarenergy double"
    return spark.createDataFrame([(n, T0 + d * H, T0 + i * H, t, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for n, d, i, t in rows], cols)


def test_forecasts(spark):
    w = weather(spark, [
        ("Athens, Greece", 1, 1, 1.0), ("Athens, Greece", 2, 1, 2.0), ("Heraklion, Greece", 2, 1, 3.0),
        ("Athens, Greece", 2, 1.4, 7.0), ("Athens, Greece", 3, 2, 4.0), ("Patras, Greece", 5, 1, 9.0),
    ])
    got = {((r.ingested_hour_utc - T0) // H, (r.datetime - T0) // H): r for r in build_forecasts(w).collect()}
    # 1.4 rounds to vintage 1 and, being later, wins there; hour 5 has an unlisted city only
    assert set(got) == {(1, 2), (1, 5), (2, 3)} and got[1, 2].temp_athens == 7.0 and got[1, 2].temp_heraklion == 3.0
    assert got[1, 2].forecast_offset_h == 1 and got[1, 5].temp_athens is None
    only = spark.createDataFrame([(T0 + 2 * H,)], "ingested_hour_utc timestamp")
    assert build_forecasts(w, only).count() == 1
    assert latest_weather(w).count() == 5


def test_unknown_scope(spark):
    with pytest.raises(ValueError):
        build_historic(spark.range(1), spark.range(1), feature_scope="other")
