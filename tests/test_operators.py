"""Operators on a few literal rows, checked by hand or against a plain-Python rule."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from gridtide import functions as fx
from gridtide import operators as op
from gridtide.operators.hot import SLICE
from gridtide.schemas import FUELS, sanitize


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- scalars -----------------------------------------------------------------

def test_parse_utc_needs_millis_and_never_fails(spark):
    df = spark.createDataFrame([("2024-01-01T05:00:00.000Z",), ("2024-01-01T05:00:00Z",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(fx.parse_utc("t")).collect()]
    assert got == [ts("2024-01-01T05:00:00"), None, None, None]


def test_local_to_utc_over_dst(spark):
    cases = {
        "2024-01-15T12:00:00": "2024-01-15T10:00:00",
        "2024-07-15T12:00:00": "2024-07-15T09:00:00",
        "2024-03-31T03:30:00": "2024-03-31T01:30:00",
        "2024-10-27T03:30:00": "2024-10-27T00:30:00",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string")
    for got, want in df.select(fx.local_to_utc("t", "EET"), "want").collect():
        assert got == ts(want)


def test_round_to_hour(spark):
    cases = [("2024-01-01T10:29:59", 10), ("2024-01-01T10:30:00", 11), ("2024-01-01T23:45:00", 0)]
    df = spark.createDataFrame([(ts(t),) for t, _ in cases], "t timestamp")
    assert [r[0].hour for r in df.select(fx.round_to_hour("t")).collect()] == [h for _, h in cases]


def test_calendar_and_offset(spark):
    df = spark.createDataFrame([(ts("2024-12-30T05:40:00"), ts("2024-12-30T04:00:00"))], "d timestamp, v timestamp")
    got = fx.calendar_features(df, "d").select(
        "hour_of_day", "day_of_week", "month", "day_of_year", "week_of_year", fx.forecast_offset("d", "v").alias("o"),
        fx.forecast_offset("v", "d").alias("back"),
    )
    assert rows(got) == [(5, 2, 12, 365, 1, 1, -2)]
    assert dict(got.dtypes)["o"] == "bigint" and dict(got.dtypes)["month"] == "int"


def test_columns_by_prefix_and_type(spark):
    df = spark.createDataFrame([], "lag_a_0h bigint, lag_b string, temp_x double, temp_y float, other int")
    assert fx.feature_columns(df, ("lag_", "temp_")) == ["lag_a_0h", "lag_b", "temp_x", "temp_y"]
    assert fx.numeric_columns(df, ["lag_a_0h", "lag_b", "temp_x", "temp_y", "other", "gone"]) == [
        "lag_a_0h", "temp_x", "other"
    ]
    assert sanitize("Nea Smyrni, Greece") == "nea_smyrni"


def test_fill_and_drop(spark):
    df = spark.createDataFrame(
        [(1, 1.0, True), (None, 1.0, None), (1, float("nan"), True), (1, None, True)], "a bigint, b double, c boolean"
    )
    assert rows(fx.fill_numeric(df)) == [(1, 1.0, True), (0, 1.0, None), (1, 0.0, True), (1, 0.0, True)]
    assert fx.fill_numeric(df, None).filter("a IS NULL").count() == 1
    assert rows(fx.drop_incomplete(df)) == [(1, 1.0, True)]
    assert fx.drop_incomplete(df, ["a", "b"]).count() == 1


# --- ranges --------------------------------------------------------------------

def test_lookbacks(spark):
    at = ts("2024-01-02T12:40:00")
    df = spark.createDataFrame([(at - dt.timedelta(hours=h),) for h in range(30)], "t timestamp")
    assert op.lookback(df, "t", 12, at).count() == 13
    assert op.lookback(df, "t", 12).count() == 0
    # the anchor is 12:00, so the bound is 00:00 (or, with 4 hours more, 20:00 the day before)
    assert op.anchored_lookback(df, "t", 12).count() == 13
    assert op.anchored_lookback(df, "t", 12, extra_hours=4).count() == 17
    other = spark.createDataFrame([(ts("2024-01-02T10:40:00"),)], "m timestamp")
    assert op.anchored_lookback(df, "t", 0, other).count() == 3


def test_split_and_horizon(spark):
    v = ts("2024-01-01T12:00:00")
    df = spark.createDataFrame([(v + dt.timedelta(hours=h), v) for h in range(-2, 27)], "d timestamp, v timestamp")
    seen, ahead = op.split_observed_forecast(df, "d", "v")
    assert (seen.count(), ahead.count()) == (3, 26)
    offsets = ahead.unionByName(seen).withColumn("forecast_offset_h", fx.forecast_offset("d", "v"))
    assert sorted(r[0] for r in op.horizon(offsets).select("forecast_offset_h").collect()) == list(range(1, 25))


# --- merges ----------------------------------------------------------------------

T = [(1, "a"), (2, "b"), (None, "n")]
KV = "k bigint, v string"


def test_upsert(spark):
    target, source = spark.createDataFrame(T, KV), spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, k bigint")
    got = sorted(rows(op.upsert(target, source, ["k"])), key=str)
    assert got == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=str)


def test_upsert_is_idempotent_and_covers_the_union_of_keys(spark):
    rnd = random.Random(3)
    target = spark.createDataFrame([(k, "t") for k in range(50)], KV)
    source = spark.createDataFrame([(k, "s") for k in rnd.sample(range(80), 40)], KV)
    once = op.upsert(target, source, ["k"])
    twice = op.upsert(once, source, ["k"])
    assert sorted(rows(once)) == sorted(rows(twice))
    assert once.count() == target.select("k").union(source.select("k")).distinct().count()


def test_upsert_rejects_two_sources_for_one_target_only(spark):
    target = spark.createDataFrame(T, KV)
    unmatched = spark.createDataFrame([(9, "x"), (9, "y")], KV)
    assert op.upsert(target, unmatched, ["k"]).count() == 5
    matched = spark.createDataFrame([(2, "x"), (2, "y")], KV)
    with pytest.raises(Exception, match="several source rows"):
        op.upsert(target, matched, ["k"]).collect()
    assert op.upsert(target, matched, ["k"], validate=False).count() == 3


def test_insert_new(spark):
    target, source = spark.createDataFrame(T, KV), spark.createDataFrame([(2, "B"), (3, "C"), (3, "D"), (None, "N")], KV)
    got = sorted(rows(op.insert_new(target, source, ["k"])), key=str)
    assert got == sorted(T + [(3, "C"), (3, "D"), (None, "N")], key=str)


# --- latest, pivot ---------------------------------------------------------------

def test_latest_per_key_and_ties(spark):
    data = [("z", 1, "old"), ("z", 2, "new"), ("y", 1, "one"), ("x", 5, "p"), ("x", 5, "q")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    got = {r[0]: r[2] for r in op.latest_per_key(df, ["k"], ["t"]).collect()}
    assert got["z"] == "new" and got["y"] == "one"
    back = spark.createDataFrame(data[::-1], "k string, t int, v string")
    assert {r[0]: r[2] for r in op.latest_per_key(back, ["k"], ["t"]).collect()} == got


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = op.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_pivot(spark):
    data = [
        (1, "Athens, Greece", 1, 10.0, 5.0), (1, "Athens, Greece", 2, 11.0, None),
        (1, "Patras, Greece", 1, 99.0, 99.0), (2, "Volos, Greece", 1, 1.0, 2.0),
    ]
    df = spark.createDataFrame(data, "h int, name string, t int, temp double, hum double")
    got = op.pivot_measures(df, ["h"], "name", ["Athens, Greece", "Volos, Greece"], ["temp", "hum"], ["t"])
    assert got.columns == ["h", "temp_athens", "hum_athens", "temp_volos", "hum_volos"]
    # the later row is taken whole, its NULL included
    assert sorted(rows(got)) == [(1, 11.0, None, None, None), (2, None, None, 1.0, 2.0)]
    one = op.pivot_measures(df, ["h"], "name", ["Volos, Greece"], ["temp"], ["t"])
    assert one.columns == ["h", "temp_volos"]


# --- lag and rolling mean ----------------------------------------------------------

def by_hand(data, window=24):
    out = {}
    for zone in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == zone), key=lambda r: r[1])
        for i, (_, t, x) in enumerate(mine):
            frame = [r[2] for r in mine[max(0, i - window + 1): i + 1] if r[2] is not None]
            out[zone, t] = (
                x, mine[i - 1][2] if i else None, round(sum(frame) / len(frame), 6) if frame else None
            )
    return out


def series(n_big, n_small, seed=1):
    """One zone with most of the rows, gaps and bursts; two small ones; some NULLs."""
    rnd, start, data = random.Random(seed), ts("2024-01-01T00:00:00"), []
    for zone, n in (("big", n_big), ("small", n_small), (None, 5)):
        t = start
        for _ in range(n):
            t += dt.timedelta(hours=rnd.choice([1, 1, 1, 1, 7, 400 if rnd.random() < 0.05 else 1]))
            data.append((zone, t, None if rnd.random() < 0.1 else float(rnd.randint(0, 99))))
    rnd.shuffle(data)
    return data


@pytest.mark.parametrize(
    "options",
    [None, {"min_rows": 3, "slice_rows": 7}, {"min_rows": 100, "slice_rows": 50}, {"min_rows": 3, "slice_rows": 1}],
)
def test_lag_rolling_equals_plain_rule_however_it_is_cut(spark, options):
    data = series(300, 40)
    df = spark.createDataFrame(data, "zone string, t timestamp, x double").repartition(5)
    got = op.lag_rolling_features(df, ["x"], ["zone"], ["t"], hot_options=options)
    assert got.columns == ["zone", "t", "x", "lag_x_0h", "lag_x_1h", "rolling_avg_x_24h"]
    want = by_hand(data)
    seen = {}
    for r in got.collect():
        mean = None if r.rolling_avg_x_24h is None else round(r.rolling_avg_x_24h, 6)
        seen[r.zone, r.t] = (r.lag_x_0h, r.lag_x_1h, mean)
    assert got.count() == len(data) and seen == want


def test_uncut_window_has_one_shuffle(spark):
    df = spark.createDataFrame(series(20, 5), "zone string, t timestamp, x double")
    made = op.lag_rolling_features(df, ["x"], ["zone"], ["t"], split_hot=False)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("at", ["id * 60", "IF(id % 10 < 9, id DIV 1000, id * 1000)", "7"])
def test_hot_group_is_cut_by_rows(spark, at):
    # evenly in time, nine tenths of the rows in a dense stretch, and all rows at one instant
    df = spark.range(100_000).selectExpr("IF(id % 100 = 0, 'cold', 'hot') AS zone", f"timestamp_seconds({at}) AS t", "id")
    assert [r[0] for r in op.hot_groups(df, ["zone"], min_rows=2000).collect()] == ["hot"]
    cut = op.sliced(df.filter("zone = 'hot'"), ["zone"], ["t", "id"], 99_000, slice_rows=2000)
    sizes = [r[1] for r in cut.groupBy(SLICE).agg(F.count("*")).collect()]
    assert sum(sizes) == 99_000 and max(sizes) <= 4000


def test_small_slices_share_a_task_and_its_file(spark):
    df = spark.range(20_000).selectExpr("id % 2 AS zone", "id div 4 AS t")
    cut = op.sliced(df, ["zone"], ["t"], 20_000, slice_rows=10)
    spans = cut.groupBy("zone", SLICE).agg(F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last")).collect()
    assert len(cut.inputFiles()) <= 1 and len(spans) >= 2000 and sum(r.n for r in spans) == 20_000
    by_slice = sorted((r.zone, r[SLICE], r.first, r.last) for r in spans)
    assert all(a[3] < b[2] for a, b in zip(by_slice, by_slice[1:]) if a[0] == b[0])


def test_hot_does_not_depend_on_the_other_groups(spark):
    df = spark.range(1000).selectExpr("id % 40 AS zone", "id AS t")
    assert op.hot_groups(df, ["zone"], min_rows=24).count() == 40
    assert op.hot_groups(df, ["zone"], min_rows=25).count() == 0


def test_upsert_with_copies_in_the_target(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, x string")
    source = spark.createDataFrame([(1, "S"), (3, "new"), (None, "m")], "k int, x string")
    for small in (False, True):
        got = rows(op.upsert(target, source, ["k"], small_source=small))
        assert sorted(got, key=repr) == sorted([(1, "S"), (1, "S"), (2, "c"), (3, "new"), (None, "n"), (None, "m")], key=repr)


# --- payloads -----------------------------------------------------------------------

def power_payload(**hour):
    return json.dumps({"zone": "GR", "history": [{"zone": "GR", "datetime": "2024-01-01T05:00:00.000Z", **hour}]})


def bronze(spark, *texts):
    at = ts("2024-01-01T06:10:00")
    return spark.createDataFrame([("s", t, at) for t in texts], "source string, raw_json string, ingested_at timestamp")


def test_power_payloads(spark):
    good = power_payload(
        powerConsumptionBreakdown={"gas": 5, "wind": None, "other": 7}, powerImportBreakdown={"AL": 1, "IT": 2},
        powerConsumptionTotal=12.5, powerProductionTotal=3, isEstimated=True, updatedAt="x",
    )
    df = op.flatten_power(bronze(spark, good, "{broken", '{"zone": "GR"}', '{"history": []}', '{"history": null}'))
    got = df.collect()
    assert len(got) == 1 and len(df.columns) == 4 + 2 * 10 + 2 + 8
    r = got[0]
    assert (r.zone, r.datetime, r.isEstimated) == ("GR", ts("2024-01-01T05:00:00"), True)
    assert (r.consumption_gas, r.consumption_wind, r.consumption_oil, r.import_AL, r.import_TR) == (5, None, None, 1, None)
    assert (r.consumption_total, r.production_total, r.production_gas) == (None, 3, None)


def test_fraction_in_a_map(spark):
    text = power_payload(powerConsumptionBreakdown={"gas": 5.6, "coal": 2})
    lenient = op.flatten_power(bronze(spark, text)).first()
    assert (lenient.consumption_gas, lenient.consumption_coal) == (6, 2)
    strict = op.flatten_power(bronze(spark, text), strict=True).first()
    assert all(strict[f"consumption_{f}"] is None for f in FUELS)


def test_carbon_payloads(spark):
    text = json.dumps({"history": [
        {"zone": "GR", "datetime": "2024-01-01T05:00:00.000Z", "carbonIntensity": 300, "isEstimated": False},
        {"zone": "GR", "datetime": "2024-01-01T06:00:00Z", "carbonIntensity": 301},
    ]})
    got = op.flatten_carbon(bronze(spark, text))
    assert got.columns == ["ingested_at", "zone", "datetime", "isEstimated", "carbon_intensity"]
    assert [(r.datetime, r.carbon_intensity) for r in got.collect()] == [(ts("2024-01-01T05:00:00"), 300), (None, 301)]


HEAD = "name,latitude,longitude,datetime,temp,humidity,precip,windspeed,winddir,cloudcover,solarenergy,stations"


def csv_bronze(spark, text):
    return spark.createDataFrame([("Athens, Greece", text, ts("2024-01-01T06:10:00"))], "location_name string, raw_csv string, ingested_at timestamp")


def test_weather_payloads(spark):
    text = "\r\n".join([
        HEAD,
        '"Athens, Greece",37.9,23.7,2024-01-01T02:00:00,9.5,80,,3.1,NaN,n/a,0.0,"S1,S2"',
        "",
        '"A ""quoted"" name\nin two lines",37.9,23.7,2024-07-01T02:00:00,9,,1,1,1,1,1,',
        "",
    ])
    df = op.flatten_weather(csv_bronze(spark, text))
    assert df.columns == HEAD.split(",") + ["ingested_at"]
    a, b = df.collect()
    assert (a.name, a.datetime, a.temp, a.humidity, a.precip) == ("Athens, Greece", ts("2024-01-01T00:00:00"), 9.5, 80.0, None)
    assert (a.winddir, a.cloudcover, a.solarenergy, a.stations) == (None, None, 0.0, "S1,S2")
    assert (b.name, b.datetime, b.stations) == ('A "quoted" name\nin two lines', ts("2024-06-30T23:00:00"), None)


def test_weather_header_lines(spark):
    line = "X,1,1,2024-01-01T02:00:00,1,1,1,1,1,1,1,s"
    assert op.flatten_weather(csv_bronze(spark, "\n".join([HEAD, line, line]))).count() == 2
    assert op.flatten_weather(csv_bronze(spark, "\n".join([HEAD, line, line])), header_lines=2).count() == 1


def test_long_weather_payload(spark):
    line = '"X, Y",1,1,2024-01-01T02:00:00,1,1,1,1,1,1,1,"' + "s" * 20_000 + '"'
    assert op.flatten_weather(csv_bronze(spark, "\n".join([HEAD] + [line] * 200))).count() == 200
