"""A full refresh and any sequence of incremental runs give the same tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helioframe.functions.clock import Clock
from helioframe.operators.staging import latest_string_currents
from helioframe.operators.status import alarm_status, current_alarm_states
from helioframe.plans.warehouse import Inputs, Limits, Warehouse
from helioframe.sources import sinks
from helioframe.sources import testdata as td
from helioframe.sources.testdata import Telemetry

SF = "/root/testdata/sf0.001"
LIMITS = Limits(
    valid_from=td.VALID_FROM,
    lookback=td.LOOKBACK,
    stale_after=td.STALE_AFTER,
    window=td.WINDOW,
    weather_horizon="2 months",
    allowed_lateness="2 hours",
)
COMPARED = [
    "stg_inverter_analogic_data",
    "stg_meter_analogic_data",
    "stg_relay_discrete_data",
    "int_events_alarms",
    "int_inverter_daily_energy_timeseries",
    "int_inverter_power_plant_daily_energy_timeseries",
    "int_meter_latest_readings",
    "int_weather_station_latest_readings",
    "int_inverter_availability",
]


@pytest.fixture(scope="module")
def inputs(spark):
    data = Telemetry(spark, SF)
    raw = {}
    for kind in td.KINDS:
        # Payload times are whole hours and arrivals lie inside the hour, so a cut inside an hour makes
        # a later batch bring newer versions of stored rows.
        raw[kind] = data.raw(kind)
    return data, Inputs(raw, data.devices(), data.plants(), data.catalog())


@pytest.fixture(scope="module")
def full(spark, inputs, tmp_path_factory):
    data, given = inputs
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("full")), given, LIMITS)
    warehouse.run(data.clock(), full=True)
    return warehouse


def test_incremental_runs_equal_a_full_refresh(spark, inputs, full, tmp_path):
    data, given = inputs
    warehouse = Warehouse(spark, str(tmp_path), given, LIMITS)
    end = data.clock().as_of
    choice = random.Random(7)
    cuts = sorted(end - timedelta(hours=choice.uniform(1, 400)) for _ in range(1))
    for moment in [*cuts, end]:
        warehouse.run(Clock(moment))
    for name in COMPARED:
        assert rows(warehouse.table(name)) == rows(full.table(name)), name
    mart = "mart_power_plants_overview"
    assert rows(warehouse.table(mart)) == rows(full.table(mart))
    assert rows(warehouse.string_currents()) == rows(full.string_currents())

    before = {name: rows(warehouse.table(name)) for name in COMPARED}
    for kind in ("inverter", "meter"):
        warehouse.positions.write(f"raw_{kind}", cuts[0])
        days = warehouse.load(kind, Clock(end))
    warehouse.refresh_events(Clock(end))
    warehouse.refresh_energy(Clock(end), days=days)
    assert {name: rows(warehouse.table(name)) for name in COMPARED} == before


def test_views_and_maintenance(spark, inputs, full):
    data, _ = inputs
    full.register_views(data.clock())
    assert spark.table("int_power_plant_status").count() == 20
    assert spark.table("int_inverter_latest_readings").count() > 0
    whole = latest_string_currents(full.inputs.raw["inverter"], full.inputs.devices, full.limits.valid_from)
    assert rows(spark.table("stg_inverter_string_data")) == rows(whole) != []

    assert full.positions.read("settled_events") is not None
    assert rows(alarm_status(full.current_events())) == rows(alarm_status(full.table("int_events_alarms")))
    failed = {(r["table_name"], r["column_name"]) for r in full.checks(data.clock()).filter("failures > 0").collect()}
    assert failed == {("stg_inverter_analogic_data", "power_reactive")}

    path = full.path("stg_logger_analogic_data")
    stored = rows(full.table("stg_logger_analogic_data").drop("date"))
    days = sinks.partition_values(spark, path)
    assert sinks.compact(spark, path, data.clock(), days=3) == [d for d in days if "2024-01-20" <= d <= "2024-01-22"]
    assert rows(full.table("stg_logger_analogic_data").drop("date")) == stored

    gone = sinks.drop_expired(spark, path, data.clock(), "10 days")
    assert gone == [d for d in days if d < "2024-01-20"]
    assert full.table("stg_logger_analogic_data").agg(F.min("timestamp")).first()[0] >= datetime(2024, 1, 20)


def test_acknowledged_alarms_reach_the_overview(spark, inputs, full):
    data, given = inputs
    high = alarm_events(full)
    some = high.select("id", F.lit("ana").alias("acknowledged_by"), F.col("timestamp").alias("acknowledged_at"))
    # A second, older mark of the same event does not count.
    again = some.withColumns({"acknowledged_by": F.lit("old"), "acknowledged_at": F.col("acknowledged_at") - F.expr("INTERVAL 1 DAY")})
    marks = some.unionByName(again)
    before = overview_states(full, data)
    critical = {plant for plant, state in before.items() if state == "critical"}
    assert critical
    others = {plant: state for plant, state in before.items() if plant not in critical}

    def states(marked):
        given_marks = Inputs(given.raw, given.devices, given.plants, given.catalog, marked)
        return overview_states(Warehouse(spark, full.root, given_marks, LIMITS), data)

    assert states(marks) == others | {plant: "acknowledged" for plant in critical}
    # One open alarm of a plant keeps it critical.
    open_one = high.agg(F.min_by("id", F.struct(~F.col("power_plant_id").isin(*critical), "id"))).first()[0]
    plant = high.filter(F.col("id") == open_one).first()["power_plant_id"]
    expected = others | {p: "critical" if p == plant else "acknowledged" for p in critical}
    assert states(marks.filter(F.col("id") != open_one)) == expected
    marked = Warehouse(spark, full.root, Inputs(given.raw, given.devices, given.plants, given.catalog, marks), LIMITS)
    assert {r[0] for r in marked.current_events().filter("acknowledged").select("acknowledged_by").distinct().collect()} == {"ana"}


def alarm_events(warehouse):
    """The events that are the current state of a high alarm."""
    newest = current_alarm_states(warehouse.current_events()).select("power_plant_id", "device_id", "code", "timestamp")
    events = warehouse.current_events().filter("type = 'alarm' AND severity = 'high'")
    return events.join(newest, ["power_plant_id", "device_id", "code", "timestamp"], "left_semi")


def overview_states(warehouse, data):
    return {r["power_plant_id"]: r["power_plant_status"] for r in warehouse.overview(data.clock()).collect()}


def test_a_plant_with_inverters_only(spark, inputs, tmp_path):
    data, given = inputs
    only = Inputs({"inverter": given.raw["inverter"]}, given.devices, given.plants, given.catalog)
    warehouse = Warehouse(spark, str(tmp_path), only, LIMITS)
    # The clock stands before the cut-off, so there are readings but no events yet.
    warehouse.run(Clock(datetime(2024, 1, 2, 12)))
    assert warehouse.events().count() == 0
    assert warehouse.table("stg_inverter_analogic_data").count() > 0
    mart = warehouse.table("mart_power_plants_overview")
    assert mart.count() == 20
    assert mart.filter("irradiance_wm2 <> 0 OR pr_pct IS NOT NULL").count() == 0


def raw_inverter(spark, *readings):
    """Raw rows from (arrival, payload time, device, state of code 2003), both times of 20 January."""
    made = [
        (datetime.fromisoformat(f"2024-01-20 {arrival}:00"), 1, device, f'{{"timestamp":"{payload}:00Z","2003":"{state}"}}')
        for arrival, payload, device, state in readings
    ]
    frame = spark.createDataFrame(made, "timestamp timestamp_ntz, power_plant_id long, device_id long, json_data string")
    return frame.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_late_arrivals_late_readings_and_a_clock_ahead(spark, inputs, tmp_path):
    _, given = inputs
    batches = [
        [("11:00", "2024-01-20 11:00", 1, 0), ("12:05", "2024-01-20 12:05", 1, 1)],
        # Written late: it arrived before the newest row of the first run.
        [("12:03", "2024-01-20 12:03", 7, 1)],
        # A reading from long before the settled time, a device whose clock is ahead, and a usual reading.
        [("16:00", "2024-01-20 09:00", 1, 1), ("16:01", "2035-01-01 00:00", 13, 1), ("16:02", "2024-01-20 16:02", 1, 0)],
        [("16:30", "2024-01-20 16:30", 1, 1), ("16:31", "2024-01-20 16:31", 7, 0)],
    ]
    hours = ["12:10", "12:20", "16:10", "16:40"]

    def warehouse(name, rows_so_far):
        raw = {"inverter": raw_inverter(spark, *rows_so_far)}
        return Warehouse(spark, str(tmp_path / name), Inputs(raw, given.devices, given.plants, given.catalog), LIMITS)

    arrived = []
    for batch, hour in zip(batches, hours):
        arrived += batch
        clock = Clock(datetime.fromisoformat(f"2024-01-20 {hour}:00"))
        step = warehouse("steps", arrived)
        for kind in step.inputs.raw:
            step.load(kind, clock)
        step.refresh_events(clock)
        step.commit()
        whole = warehouse(f"whole-{hour[:2]}{hour[3:]}", arrived)
        whole.load("inverter", clock, full=True)
        whole.refresh_events(clock, full=True)
        for name in ("stg_inverter_analogic_data", "stg_inverter_discrete_data", "int_events_alarms"):
            assert rows(step.table(name)) == rows(whole.table(name)), (hour, name)
    assert step.table("stg_inverter_discrete_data").count() == 8
    assert step.table("int_events_alarms").filter("device_id = 13").count() == 0
