"""Frames by time, cut and uncut, against a plain loop."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from gridtide import operators as op

START = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)


def gappy(seed: int) -> list[tuple]:
    """Dense stretches, gaps of days, times off the hour, a NULL group and NULL values."""
    rnd = random.Random(seed)
    out = []
    for zone in ("A", "B", None):
        at = START
        for _ in range(150):
            at += rnd.choice([HOUR, HOUR, HOUR, HOUR / 4, 23 * HOUR, 24 * HOUR, 60 * HOUR, dt.timedelta(microseconds=1)])
            out.append((zone, at, None if rnd.random() < 0.1 else float(rnd.randint(0, 99))))
    rnd.shuffle(out)
    return out


def by_loop(data, lags, hours):
    want = {}
    for zone, at, _ in data:
        mine = [(t, x) for z, t, x in data if z == zone]
        known = dict(mine)
        near = [x for t, x in mine if at - hours * HOUR < t <= at and x is not None]
        mean = round(sum(near) / len(near), 6) if near else None
        want[zone, at] = (*[known.get(at - n * HOUR) for n in lags], mean)
    return want


@pytest.mark.parametrize(
    "options", [None, {"min_rows": 3, "slice_rows": 7}, {"min_rows": 100, "slice_rows": 40}, {"min_rows": 3, "slice_rows": 1}]
)
@pytest.mark.parametrize("lags,hours", [((1, 24), 24), ((48,), 6)])
def test_equals_a_loop_however_it_is_cut(spark, options, lags, hours):
    data = gappy(7)
    df = spark.createDataFrame(data, "zone string, t timestamp, x double").repartition(4)
    got = op.time_range_features(df, ["x"], ["zone"], "t", lags, hours, hot_options=options)
    names = [*[f"lag_x_exact_{n}h" for n in lags], f"rolling_avg_x_range_{hours}h"]
    assert got.columns == ["zone", "t", "x", *names]
    rows = got.collect()
    seen = {(r.zone, r.t): tuple(None if r[n] is None else round(r[n], 6) for n in names) for r in rows}
    assert len(rows) == len(data) and seen == by_loop(data, lags, hours)


def test_rows_without_a_time_and_no_rows(spark):
    schema = "zone string, t timestamp, x double"
    got = op.time_range_features(spark.createDataFrame([("A", None, 1.0), ("A", START, 2.0)], schema), ["x"], ["zone"], "t")
    seen = {r.t: tuple(r)[2:] for r in got.collect()}
    assert seen == {None: (1.0, None, None), START: (2.0, None, 2.0)}
    assert op.time_range_features(spark.createDataFrame([], schema), ["x"], ["zone"], "t").count() == 0


def test_uncut_frames_share_one_shuffle_and_one_sort(spark):
    df = spark.createDataFrame(gappy(1), "zone string, t timestamp, x double")
    made = op.time_range_features(df, ["x"], ["zone"], "t", split_hot=False)
    timed = made._jdf.queryExecution().executedPlan().toString()
    assert timed.count("Exchange") == 1 and timed.count("Sort [") == 1
