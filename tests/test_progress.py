"""Marks of how far readers have come, and jobs that take up where they stopped."""

from __future__ import annotations

import datetime as dt

from gridtide import schemas as S
from gridtide.plans import jobs
from gridtide.plans.gold import build_historic
from gridtide.plans.silver import build_energy
from gridtide.sources import commit_marks, hours_since, marks, read_table
from tests import payloads
from tests.test_jobs import ingest, rounded, rows

AT = dt.datetime(2024, 1, 2, 3, 4, 5, 6)


def test_marks_never_fall(spark, clean_tables):
    assert marks(spark, ["a"]) == {"a": None}
    commit_marks(spark, {"a": AT, "b": None})
    commit_marks(spark, {"a": AT - dt.timedelta(days=1)})
    commit_marks(spark, {"b": None})
    assert marks(spark, ["a", "b"]) == {"a": AT, "b": None}
    commit_marks(spark, {"a": AT + dt.timedelta(microseconds=1), "b": AT})
    assert marks(spark, ["a", "b"]) == {"a": AT + dt.timedelta(microseconds=1), "b": AT}


def test_hours_reach_the_mark():
    assert hours_since(None, AT) == hours_since(AT, None) == hours_since(AT, AT) == hours_since(AT, AT - dt.timedelta(days=9)) == 0
    assert hours_since(AT, AT + dt.timedelta(hours=30)) == 30
    assert hours_since(AT, AT + dt.timedelta(hours=30, microseconds=1)) == 31


def test_a_pause_longer_than_the_lookback_loses_nothing(spark, clean_tables, tmp_path):
    ingest(spark, tmp_path, 0)
    jobs.run_silver(spark, 12, payloads.run_time(0))
    jobs.run_gold(spark, 12)
    # no run of the jobs for 13 deliveries, three hours apart
    for run in range(1, 14):
        ingest(spark, tmp_path, run)
    assert payloads.run_time(13) - payloads.run_time(0) > dt.timedelta(hours=30)
    jobs.run_silver(spark, 2, payloads.run_time(13))
    jobs.run_gold(spark, 2)
    energy, weather = read_table(spark, S.SILVER_ENERGY), read_table(spark, S.SILVER_WEATHER)
    assert rows(energy) == rows(build_energy(read_table(spark, S.BRONZE_POWER), read_table(spark, S.BRONZE_CARBON)))
    assert weather.count() == 14 * 4 * 96
    gold = rows(rounded(read_table(spark, S.GOLD_HISTORIC)))
    assert gold == rows(rounded(build_historic(energy, weather)))
    clean = rows(energy)
    # again: nothing changes
    jobs.run_silver(spark, 2, payloads.run_time(13))
    jobs.run_gold(spark, 2)
    assert rows(read_table(spark, S.SILVER_ENERGY)) == clean and rows(rounded(read_table(spark, S.GOLD_HISTORIC))) == gold


def test_a_first_run_has_the_lookback_alone(spark, clean_tables, tmp_path):
    for run in (0, 1):
        ingest(spark, tmp_path, run)
    jobs.run_silver(spark, 1, payloads.run_time(1))
    assert {r.ingested_at for r in read_table(spark, S.SILVER_ENERGY).select("ingested_at").distinct().collect()} == {payloads.run_time(1)}
