"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from gridtide import operators as op
from gridtide.plans import gold, training
from gridtide.session import materialize
from gridtide.sources import read_table, upsert_table
from gridtide.workloads import feeds
from gridtide.workloads.queries import QUERIES
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def energy(spark):
    return materialize(feeds.energy(spark, SF_DIR))


@pytest.fixture(scope="module")
def weather(spark):
    return materialize(feeds.weather(spark, SF_DIR))


FIT = {"gbt_fit_score", "score_latest"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FIT))
def test_no_nested_loops_and_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "CollectLimit"):
        assert word not in text, word


def test_lookback_bounds_reach_the_scan(energy):
    fixed = plan(op.lookback(energy, "ingested_at", 12, dt.datetime(2024, 1, 20)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ingested_at", fixed)
    found = plan(op.anchored_lookback(energy, "ingested_at", 12))
    assert re.search(r"DataFilters: \[[^\]]*ingested_at#\d+ >= Subquery", found)


def test_windows_of_a_feature_table_share_one_sort(energy, weather):
    text = plan(gold.build_historic(energy, weather))
    assert text.count("+- Window ") == 1
    # the weather is counted, found small and broadcast: one shuffle of energy rows, one of weather rows
    assert text.count("Exchange hashpartitioning") == 2


def test_training_shuffles_the_snapshot_once(spark, energy, weather):
    historic = materialize(gold.build_historic(energy, weather))
    forecasts = materialize(gold.build_forecasts(weather))
    text = plan(training.build_training(historic, forecasts))
    wide = [line for line in text.splitlines() if "FileScan" in line and "rolling_avg_carbon_intensity_24h" in line]
    assert len(wide) == 1


def test_time_filters_prune_days(spark, clean_tables, energy):
    from gridtide import schemas as S

    upsert_table(spark, S.SILVER_ENERGY, energy, ["zone", "datetime"])
    table = read_table(spark, S.SILVER_ENERGY, with_day=True)
    some = op.from_time(table, F.lit(dt.datetime(2024, 1, 29)))
    assert re.search(r"PartitionFilters: \[[^\]]*_day", plan(some))
    assert {r[0] for r in some.select(F.input_file_name()).distinct().collect()} < {
        r[0] for r in table.select(F.input_file_name()).distinct().collect()
    }
    latest = op.latest_snapshot(table, "datetime")
    assert re.search(r"PartitionFilters: \[[^\]]*_day[^\]]*Subquery", plan(latest))
    assert latest.count() == energy.filter(F.col("datetime") == energy.agg(F.max("datetime")).scalar()).count()


def test_small_source_leaves_the_target_unshuffled(spark, energy):
    keys = ["zone", "datetime"]
    text = plan(op.upsert(energy, energy, keys, small_source=True))
    # the source by key, and the keys that both sides have
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 2
    assert op.broadcast_if_small(energy, 10) is energy
