from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gridtide.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "gridtide-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def clean_tables(spark):
    """Drop the pipeline's tables before and after a test."""
    from gridtide import schemas as S

    names = [v for k, v in vars(S).items() if k.startswith(("BRONZE_", "SILVER_", "GOLD_", "PROGRESS"))]

    def drop():
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    drop()
    yield
    drop()
