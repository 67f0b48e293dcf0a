"""Change detection against a plain loop, also for a code that owns most of the rows."""

from __future__ import annotations

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from helioframe.operators.events import (
    explode_codes,
    last_known_states,
    rejected_codes,
    state_changes,
    state_changes_after,
    with_acknowledgements,
)

SCHEMA = "timestamp timestamp_ntz, power_plant_id bigint, device_id bigint, device_type_id int, discrete_data_json string"
START = datetime(2026, 1, 6)


def loop_changes(readings, states=None):
    """The definition: a value differs from the one before it, or is the first."""
    last = dict(states or {})
    found = []
    for moment, _, device, _, payload in sorted(readings, key=lambda r: (r[2], r[0])):
        for code, text in json.loads(payload).items():
            value = {"0": 0, "1": 1, "true": 1, "false": 0}.get(text)
            if value is None:
                continue
            if last.get((device, code)) != value:
                found.append((moment, device, code, value))
            last[(device, code)] = value
    return sorted(found, key=repr)


def detected(df):
    return rows(df, "timestamp", "device_id", "code", "value")


def random_readings(seed, count, hot_share):
    choice = random.Random(seed)
    seen, readings = set(), []
    while len(readings) < count:
        device = 1 if choice.random() < hot_share else choice.randint(2, 6)
        moment = START + timedelta(minutes=choice.randint(0, 60 * 24 * 4))
        if (device, moment) in seen:
            continue
        seen.add((device, moment))
        payload = {"a": choice.choice("01"), "b": choice.choice(["true", "false", "x"]), "c": "0"}
        if choice.random() < 0.3:
            del payload["a"]
        readings.append((moment, device % 3, device, 1, json.dumps(payload)))
    return readings


def test_worked_example_and_every_split(spark):
    readings = [
        (START + timedelta(minutes=i), 1, 100, 2, json.dumps({"overvoltage": value})) for i, value in enumerate("00110")
    ]
    df = spark.createDataFrame(readings, SCHEMA)
    expected = [(START, 100, "overvoltage", 0), (START + timedelta(minutes=2), 100, "overvoltage", 1), (START + timedelta(minutes=4), 100, "overvoltage", 0)]
    assert detected(state_changes(df)) == expected
    for split in (2, 3, 4):
        cut = F.lit(readings[split - 1][0])
        first = state_changes(df.filter(F.col("timestamp") <= cut))
        rest = state_changes(df.filter(F.col("timestamp") > cut), last_known_states(first))
        assert detected(first.unionByName(rest)) == expected


def test_matches_a_loop_with_a_hot_device(spark):
    readings = random_readings(3, 3000, hot_share=0.7)
    states = {(1, "a"): 1, (2, "b"): 0, (9, "a"): 1}
    df = spark.createDataFrame(readings, SCHEMA)
    known = spark.createDataFrame([(d, c, v) for (d, c), v in states.items()], "device_id bigint, code string, last_value int")
    assert detected(state_changes(df)) == loop_changes(readings)
    assert detected(state_changes(df, known)) == loop_changes(readings, states)


def test_no_task_gets_the_history_of_a_hot_code(spark):
    readings = random_readings(5, 3000, hot_share=0.9)
    changes = state_changes(spark.createDataFrame(readings, SCHEMA))
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 2
    # Both windows are keyed by the hour too (the second one through its lane).
    assert all("__span" in line or "__lane" in line for line in windows)

    hours = defaultdict(int)
    for moment, _, device, _, _ in readings:
        hours[(device, moment.replace(minute=0))] += 1
    assert max(hours.values()) < len(readings) / 20


def test_binary_domain(spark):
    payload = {"2003": "1", "2011": "true", "2033": "0", "61440": "false", "x": "1@x", "y": "1.0", "z": "2", "n": None}
    df = spark.createDataFrame([(START, 1, 1, 1, json.dumps(payload))], SCHEMA)
    assert rows(explode_codes(df), "code", "value") == [("2003", 1), ("2011", 1), ("2033", 0), ("61440", 0)]
    assert rows(rejected_codes(df), "code", "rejected") == [("n", 1), ("x", 1), ("y", 1), ("z", 1)]


def test_acknowledgements(spark):
    events = spark.sql(
        "SELECT id, false AS acknowledged, CAST(NULL AS STRING) AS acknowledged_by, "
        "CAST(NULL AS TIMESTAMP_NTZ) AS acknowledged_at FROM VALUES (1L), (2L) AS e(id)"
    )
    marks = spark.createDataFrame(
        [(2, "ana", START), (2, "rui", START + timedelta(hours=1))], "id bigint, acknowledged_by string, acknowledged_at timestamp_ntz"
    )
    assert rows(with_acknowledgements(events, marks), "id", "acknowledged", "acknowledged_by") == [(1, False, None), (2, True, "rui")]


def test_changes_after_a_moment_equal_those_of_the_whole_history(spark):
    rng, readings = random.Random(11), []
    for device in range(4):
        for minute in range(0, 600, 7):
            codes = {c: rng.choice(["0", "1", "true", "odd"]) for c in "abc" if rng.random() < 0.6}
            readings.append((START + timedelta(minutes=minute), 1, device, 1, json.dumps(codes)))
    df = spark.createDataFrame(readings, SCHEMA)
    for minute in (-1, 0, 123, 301, 700):
        moment = F.lit(START + timedelta(minutes=minute)).cast("timestamp_ntz")
        whole = state_changes(df).filter(F.col("timestamp") > moment)
        assert rows(state_changes_after(df, moment)) == rows(whole), minute
