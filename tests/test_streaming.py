"""Streams over files give what the batch operators give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helioframe.operators.energy import device_day_energy
from helioframe.operators.latest import latest_readings
from helioframe.operators.staging import stage_analog
from helioframe.functions.clock import Clock
from helioframe.plans.warehouse import Inputs, Limits, Warehouse
from helioframe.sources import testdata as td
from helioframe.sources.tables import read_raw, read_raw_stream
from helioframe.sources.testdata import Telemetry
from helioframe.streaming.feed import start_feed, upsert_each_batch
from helioframe.streaming.readings import stream_analog, stream_device_days, stream_latest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_paths(spark, tmp_path_factory):
    """Raw readings as three files per device type, in arrival order."""
    data = Telemetry(spark, SF)
    paths = {}
    for kind in ("inverter", "relay"):
        path = str(tmp_path_factory.mktemp(kind))
        for first, last in (("01", "11"), ("11", "21"), ("21", "32")):
            part = data.raw(kind).filter(
                (F.date_format("timestamp", "dd") >= first) & (F.date_format("timestamp", "dd") < last)
            )
            part.coalesce(1).write.mode("append").parquet(path)
        paths[kind] = path
    return paths


def finished(query):
    query.awaitTermination(240)
    assert query.exception() is None
    return query


def test_staging_stream_equals_batch_keys(spark, raw_paths, tmp_path):
    stream = stream_analog(read_raw_stream(spark, raw_paths["inverter"], maxFilesPerTrigger="1"), "inverter", "40 days")
    out = str(tmp_path / "out")
    finished(
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    batch = stage_analog(read_raw(spark, raw_paths["inverter"]), "inverter")
    key = ("device_id", "timestamp")
    assert rows(spark.read.parquet(out), *key) == rows(batch, *key)


def test_daily_maxima_stream(spark, raw_paths, tmp_path):
    stream = stream_device_days(read_raw_stream(spark, raw_paths["inverter"], maxFilesPerTrigger="1"))
    path = str(tmp_path / "days")
    finished(
        stream.writeStream.outputMode("update")
        .foreachBatch(upsert_each_batch(path, ["date", "device_id", "power_plant_id"]))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    batch = device_day_energy(stage_analog(read_raw(spark, raw_paths["inverter"]), "inverter", dedup=False))
    assert rows(spark.read.parquet(path).select(*batch.columns)) == rows(batch)


def test_latest_stream(spark, raw_paths, tmp_path):
    stream = stream_latest(read_raw_stream(spark, raw_paths["relay"], maxFilesPerTrigger="1"), "relay")
    path = str(tmp_path / "latest")
    finished(
        stream.withColumn("shard", F.pmod(F.hash("device_id"), F.lit(4)))
        .writeStream.outputMode("update")
        .foreachBatch(upsert_each_batch(path, ["device_id"], partition="shard"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    batch = latest_readings(stage_analog(read_raw(spark, raw_paths["relay"]), "relay"), "relay")
    assert rows(spark.read.parquet(path).select(*batch.columns)) == rows(batch)


def test_feed_equals_full_refresh(spark, raw_paths, tmp_path):
    data = Telemetry(spark, SF)
    limits = Limits(valid_from=td.VALID_FROM, allowed_lateness="2 hours")

    def warehouse(name):
        raw = {kind: read_raw(spark, path) for kind, path in raw_paths.items()}
        inputs = Inputs(raw, data.devices(), data.plants(), data.catalog())
        return Warehouse(spark, str(tmp_path / name), inputs, limits)

    fed, full = warehouse("fed"), warehouse("full")
    streams = {
        kind: read_raw_stream(spark, path, maxFilesPerTrigger="1") for kind, path in raw_paths.items()
    }
    finished(start_feed(fed, streams, str(tmp_path / "cp")))
    full.run(Clock(fed.positions.read("feed")), full=True)
    for name in (
        "stg_inverter_analogic_data",
        "stg_relay_discrete_data",
        "int_relay_latest_readings",
        "int_events_alarms",
        "int_inverter_power_plant_daily_energy_timeseries",
        "int_inverter_availability",
        "int_relay_availability",
        "mart_power_plants_overview",
    ):
        assert rows(fed.table(name)) == rows(full.table(name)), name
