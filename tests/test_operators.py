"""Staging, availability, Performance Ratio and quality checks on small literal tables."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from helioframe.functions.clock import Clock
from helioframe.operators import quality
from helioframe.operators.availability import availability
from helioframe.operators.latest import latest_readings_long
from helioframe.operators.performance import daily_irradiation, performance_ratio_by_plant
from helioframe.operators.staging import latest_string_currents, stage_analog, stage_discrete, unreadable_readings
from helioframe.schemas import DEVICES, POWER_PLANTS, RAW
from helioframe.specs import analog_columns

NOW = datetime(2026, 3, 1, 15, 0)
LOCAL = NOW - timedelta(hours=3)
CLOCK = Clock(NOW)


def raw(spark, *readings):
    """Readings of (minutes before now, device, payload)."""
    made = [
        (NOW - timedelta(minutes=ago), 1, device, payload if isinstance(payload, str) else json.dumps(payload))
        for ago, device, payload in readings
    ]
    df = spark.createDataFrame(made, "timestamp timestamp_ntz, power_plant_id bigint, device_id bigint, json_data string")
    return df.select(*(F.col(f.name).cast(f.dataType) for f in RAW))


def at(ago):
    return (NOW - timedelta(minutes=ago)).strftime("%Y-%m-%dT%H:%M:%SZ")


def test_newest_arrival_wins_and_unreadable_rows_are_told(spark):
    df = raw(
        spark,
        (9, 1, {"timestamp": at(10), "active_power": "1.5@x", "serial_number": " A1 "}),
        (8, 1, {"timestamp": at(10), "active_power": "2.5@x", "serial_number": " "}),
        (7, 1, {"timestamp": "later", "active_power": "3"}),
        (6, 2, {"active_power": "4"}),
        (5, 2, '{"timestamp": "' + at(5) + '", "active'),
    )
    staged = stage_analog(df, "inverter")
    assert staged.columns == analog_columns("inverter")
    assert rows(staged, "timestamp", "device_id", "active_power", "serial_number") == [
        (LOCAL - timedelta(minutes=10), 1, 2.5, None)
    ]
    assert stage_analog(df, "inverter", dedup=False).count() == 2
    assert unreadable_readings(df).count() == 3


def test_a_group_of_copies_collapses_before_the_shuffle(spark):
    plan = stage_analog(raw(spark, (1, 1, {"timestamp": at(1)})), "meter")._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("row_number(), 1, Partial"), plan.index("row_number(), 1, Final")
    assert final < plan.index("Exchange hashpartitioning") < partial
    assert plan.count("from_json") == 1


def test_discrete_codes(spark):
    payload = {"timestamp": at(5), "2003": "1", "communication_failure": 0, "active_power": "1", "12a": "1", "str1": "0"}
    df = raw(spark, (4, 1, payload), (3, 2, {"timestamp": at(5), "frequency": 1}))
    codes = rows(stage_discrete(df, "inverter"), "device_id", "discrete_data_json")
    assert [(d, json.loads(j)) for d, j in codes] == [(1, {"2003": "1", "communication_failure": 0})]
    relay = rows(stage_discrete(df, "relay"), "device_id", "discrete_data_json")
    assert set(json.loads(relay[0][1])) == {"2003", "communication_failure", "12a", "str1"}


def test_discrete_values_keep_their_types(spark):
    payload = {"timestamp": at(5), "2003": True, "2004": 0, "2005": "1@x", "2006": 1.5, "2007": "true", "2008": None, "communication_failure": "0"}
    kept = json.loads(rows(stage_discrete(raw(spark, (5, 1, payload)), "inverter"), "discrete_data_json")[0][0])
    assert kept == {k: v for k, v in payload.items() if k != "timestamp"}
    assert type(kept["2003"]) is bool and type(kept["2004"]) is int and type(kept["2007"]) is str


def test_string_currents(spark):
    df = raw(
        spark,
        (9, 1, {"timestamp": at(9), "string_1_current": "9"}),
        (5, 1, {"timestamp": at(5), "string_2_current": 1.236, "string_32_current": "-", "state_simplified": "2.0"}),
    )
    devices = spark.createDataFrame([(1, 1, 1, "INV 1", True)], DEVICES)
    out = latest_string_currents(df, devices, "2026-01-06 00:00:00")
    assert rows(out, "device_name", "string_number", "string_current", "state_simplified") == [("INV 1", 2, Decimal("1.24"), 2)]


def test_availability_example(spark):
    plants = spark.createDataFrame([(1, 1, "P", 100.0, None, None, None, True), (2, 1, "Q", 1.0, None, None, None, False)], POWER_PLANTS)
    devices = spark.createDataFrame([(i, 1, 1, None, True) for i in (1, 2, 3, 4)] + [(5, 1, 1, None, False), (6, 1, 2, None, True)], DEVICES)
    states = [(5, 1, 2), (5, 2, 1), (20, 3, 2), (5, 99, 2)]
    readings = stage_analog(
        raw(spark, *((ago, d, {"timestamp": at(ago), "state_simplified": s}) for ago, d, s in states)), "inverter"
    )
    known = readings.filter("device_id < 99")
    got = availability(devices, plants, known, "inverter", CLOCK)
    names = ["total_inverters", "active_inverters", "inactive_inverters", "no_data_inverters", "availability_pct"]
    assert rows(got, *names) == [(4, 1, 1, 2, Decimal("25.00"))]
    # An unregistered device counts by default and can be kept out.
    assert rows(availability(devices, plants, readings, "inverter", CLOCK), *names) == [(4, 2, 1, 1, Decimal("50.00"))]
    only = availability(devices, plants, readings, "inverter", CLOCK, restrict_to_registered=True)
    assert rows(only, *names) == [(4, 1, 1, 2, Decimal("25.00"))]


def test_display_rows(spark):
    readings = stage_analog(
        raw(spark, (5, 1, {"timestamp": at(5), "frequency": "59.97@x", "line_voltage_ab": 834.2, "power_factor": 1.0})), "inverter"
    )
    shown = rows(latest_readings_long(readings, CLOCK), "display_order", "field_name", "value_formatted")
    assert sorted(shown) == [(4, "Power Factor", "1.00 "), (7, "Frequency", "59.97 Hz"), (12, "Voltage: AB line", "834.20 V")]


def test_performance_ratio_example(spark):
    plants = spark.createDataFrame(
        [(i, 1, str(i), rated, None, None, None, True) for i, rated in ((1, 1000.0), (2, 0.0), (3, 1000.0))], POWER_PLANTS
    )
    energy = spark.sql("SELECT id AS power_plant_id, CAST(4000 AS DECIMAL(28,2)) AS et_kwh FROM VALUES (1L), (2L), (3L) AS e(id)")
    noon = datetime(LOCAL.year, LOCAL.month, LOCAL.day, 0, 0)
    weather = spark.createDataFrame(
        [(noon + timedelta(minutes=i), p, d, Decimal("1000.00")) for i in range(60) for p, d in ((1, 7), (2, 8), (1, 5))]
        + [(noon - timedelta(seconds=1), 1, 7, Decimal("9.00")), (noon + timedelta(days=1), 1, 7, Decimal("9.00"))],
        "timestamp timestamp_ntz, power_plant_id bigint, device_id bigint, irradiance_poa decimal(18,2)",
    )
    irradiation = daily_irradiation(weather, CLOCK)
    assert rows(irradiation, "power_plant_id", "ht_kwh_m2") == [(1, 5000.0), (2, 5000.0)]
    ratios = rows(performance_ratio_by_plant(plants, energy, irradiation), "power_plant_id", "pr_pct")
    assert ratios == [(1, Decimal("80.00")), (2, None), (3, None)]


def test_freshness(spark):
    sources = {"a": raw(spark, (5, 1, {})), "b": raw(spark, (20, 1, {})), "c": raw(spark, (40, 1, {})), "d": raw(spark, (1, 1, {})).limit(0)}
    report = quality.freshness_report(sources, CLOCK)
    assert rows(report, "source_name", "status") == [("a", "pass"), ("b", "warn"), ("c", "error"), ("d", "error")]


def test_duplicates_and_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'a'), (1, 'b'), (2, 'a'), (NULL, 'a'), (NULL, 'a') AS t(k, v)")
    assert rows(quality.unique_report(df, [["k"], ["k", "v"]]), "column_name", "failures") == [("k", 1), ("k, v", 1)]
    audit = quality.duplicate_audit(df.dropna(), ["k", "v"])
    assert rows(audit, "copies", "keys", "rows") == [(1, 2, 2), (2, 1, 2)]
    parents = spark.sql("SELECT * FROM VALUES ('a') AS p(v)")
    assert rows(quality.relationships_report(df, "v", parents, "v"), "failures", "missing_parents") == [(1, 1)]
