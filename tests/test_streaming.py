"""File-stream ingest: new payload files are taken once."""

from __future__ import annotations

import datetime as dt
import os

from gridtide import schemas as S
from gridtide.plans.silver import build_weather
from gridtide.plans.silver import build_energy
from gridtide.sources import insert_new_table, land_csv, land_json, land_table, read_table
from gridtide.plans.silver import WEATHER_KEYS
from gridtide.streaming.ingest import stream_energy, stream_json, stream_weather
from tests import payloads


def test_json_stream(spark, clean_tables, tmp_path):
    landing, checkpoint = tmp_path / "power", str(tmp_path / "cp")
    os.makedirs(landing)

    def run():
        stream_json(spark, str(landing), "power_data", S.BRONZE_POWER, checkpoint).awaitTermination()
        return read_table(spark, S.BRONZE_POWER).count()

    (landing / "a.json").write_text(payloads.power("GR", 0))
    assert run() == 1 and run() == 1
    (landing / "b.json").write_text(payloads.power("GR", 1))
    assert run() == 2
    kept = {r.raw_json for r in read_table(spark, S.BRONZE_POWER).collect()}
    assert kept == {payloads.power("GR", 0), payloads.power("GR", 1)}
    assert kept == {r.raw_json for r in land_json(spark, str(landing), "power_data").collect()}


def test_weather_stream(spark, clean_tables, tmp_path):
    landing = payloads.land(str(tmp_path), 0)["weather"]
    want = build_weather(land_csv(spark, landing)).count()
    assert want == 4 * 96

    def run():
        stream_weather(spark, landing, str(tmp_path / "cp")).awaitTermination()
        return read_table(spark, S.SILVER_WEATHER).count()

    assert run() == want and run() == want


def test_batch_stream_and_replay_on_one_table(spark, clean_tables, tmp_path):
    landing = tmp_path / "power"
    os.makedirs(landing)

    def stream(checkpoint):
        stream_json(spark, str(landing), "power_data", S.BRONZE_POWER, str(tmp_path / checkpoint)).awaitTermination()

    def batch():
        land_table(land_json(spark, str(landing), "power_data"), S.BRONZE_POWER)

    for run, step in enumerate((batch, lambda: stream("a"), batch, lambda: stream("a"), lambda: stream("b"), batch)):
        (landing / f"{run}.json").write_text(payloads.power("GR", run))
        step()
        step()
        assert read_table(spark, S.BRONZE_POWER).count() == run + 1
        spark.catalog.refreshTable(S.BRONZE_POWER)
        assert spark.table(S.BRONZE_POWER).count() == run + 1


def test_weather_stream_and_replay_after_a_batch(spark, clean_tables, tmp_path):
    landing = payloads.land(str(tmp_path), 0)["weather"]
    insert_new_table(spark, S.SILVER_WEATHER, build_weather(land_csv(spark, landing)), WEATHER_KEYS)
    for checkpoint in ("a", "a", "b"):
        stream_weather(spark, landing, str(tmp_path / checkpoint)).awaitTermination()
        rows = read_table(spark, S.SILVER_WEATHER)
        assert rows.count() == rows.select(*WEATHER_KEYS).distinct().count() == 4 * 96


def test_energy_stream_equals_the_batch_job(spark, clean_tables, tmp_path):
    folders = {f: str(tmp_path / f) for f in ("power", "carbon")}
    for f in folders.values():
        os.makedirs(f)
    tables = [S.SILVER_ENERGY + x for x in ("", "_power", "_carbon", "_batches")]

    def put(feed, run):
        path = os.path.join(folders[feed], f"{run}.json")
        with open(path, "w") as f:
            f.write(getattr(payloads, feed)("GR", run))
        at = payloads.run_time(run).replace(tzinfo=dt.timezone.utc).timestamp()
        os.utime(path, (at, at))

    def stream(checkpoint):
        stream_energy(spark, folders["power"], folders["carbon"], str(tmp_path / checkpoint)).awaitTermination()
        want = build_energy(land_json(spark, folders["power"], "power_data"), land_json(spark, folders["carbon"], "carbon_intensity"))
        got = read_table(spark, S.SILVER_ENERGY).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        return got.count()

    try:
        put("power", 0)
        assert stream("a") == 0  # the other feed is still missing
        put("carbon", 0)
        assert stream("a") == 24
        put("power", 9), put("carbon", 9)
        assert stream("a") == 48
        put("power", 1), put("carbon", 1)  # arrives late: older than some hours, newer than others
        stream("a")
        put("power", 8)
        stream("a")
        stream("b")  # everything again, under a fresh checkpoint
    finally:
        for name in tables[1:]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
