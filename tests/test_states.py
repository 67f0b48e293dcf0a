"""Streams with state give what the batch operators give, however the input is cut into micro-batches."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helioframe.operators.events import discrete_union, state_changes
from helioframe.operators.staging import stage_analog, stage_discrete
from helioframe.schemas import RAW
from helioframe.sources.tables import read_raw, read_raw_stream
from helioframe.streaming.states import stream_discrete, stream_staged, stream_staleness, stream_state_changes

START = datetime(2026, 2, 1, tzinfo=timezone.utc)


def reading(arrived, at, device, payload, plant=1):
    body = ",".join([f'"timestamp":"{(START + timedelta(minutes=at)):%Y-%m-%dT%H:%M:%SZ}"', *payload])
    return (START + timedelta(minutes=arrived), plant, device, "{" + body + "}")


def written(spark, folder, batches):
    seen = set()
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        # File times order the files of a stream.
        for path in Path(f"{folder}/raw").glob("*.parquet"):
            if path.name not in seen:
                seen.add(path.name)
                os.utime(path, (1_700_000_000 + number,) * 2)
    return f"{folder}/raw"


def collected(stream, folder):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@pytest.fixture(scope="module")
def history():
    """Ten hours of six devices, a busy one among them, some readings late, re-sent with other values, or without codes."""
    rng, out = random.Random(4), []
    for at in range(0, 600, 10):
        for device in (1, 1, 1, 2, 3, 4):
            minute = at + (rng.randrange(10) if device == 1 else 0)
            codes = [f'"{c}":"{rng.randrange(2)}"' for c in ("2003", "2011") if rng.random() < 0.9]
            power = [f'"active_power":"{rng.randrange(100)}.5"']
            out.append(reading(minute + rng.randrange(20), minute, device, power + codes))
            if rng.random() < 0.2:
                again = [] if rng.random() < 0.3 else [f'"2003":"{rng.randrange(2)}"']
                out.append(reading(minute + 20 + rng.randrange(9), minute, device, ['"active_power":"7"', *again]))
    return out


#: Far ahead, so that the watermark passes all that came before.
def closing(out):
    last = max(r[0] for r in out) - START
    return [reading(int(last.total_seconds() // 60) + 60 * k, 60 * 50 * k, 99, ['"active_power":"1"', '"2003":"1"']) for k in (1, 2)]


@pytest.mark.parametrize("cuts", [1, 4])
def test_streams_equal_batches_over_any_cut(spark, folder, history, cuts):
    rng = random.Random(cuts)
    arrivals = sorted(history, key=lambda r: r[0])
    bounds = sorted(rng.sample(range(1, len(arrivals)), cuts - 1))
    parts = [arrivals[a:b] for a, b in zip([0, *bounds], [*bounds, len(arrivals)])]
    path = written(spark, folder, [*parts, *([row] for row in closing(history))])
    batch = read_raw(spark, path).filter("device_id <> 99")

    def stream():
        return read_raw_stream(spark, path, maxFilesPerTrigger="1")

    staged = collected(stream_staged(stream(), "inverter", "2 hours"), f"{folder}/analog").drop("event_time").filter("device_id <> 99")
    wanted = stage_analog(batch, "inverter")
    assert rows(staged.select(*wanted.columns)) == rows(wanted)

    changes = stream_state_changes(stream_discrete(stream(), "inverter", "2 hours"), "inverter")
    found = collected(changes, f"{folder}/changes").filter("device_id <> 99")
    wanted = state_changes(discrete_union({"inverter": stage_discrete(batch, "inverter")}))
    assert wanted.count() > 100
    assert rows(found.select(*wanted.columns)) == rows(wanted)


def test_a_silent_device_turns_stale_and_absent(spark, folder):
    talks = [[reading(m, m, 1, [])] + ([reading(m, m, 2, [])] if m in (0, 10, 200) else []) for m in range(0, 320, 10)]
    path = written(spark, folder, [sum(talks[k : k + 4], []) for k in range(0, len(talks), 4)])
    stream = stream_staleness(read_raw_stream(spark, path, maxFilesPerTrigger="1"), timedelta(minutes=45), timedelta(minutes=100))
    found = collected(stream, folder)
    since = F.expr("CAST((unix_timestamp(since) - unix_timestamp(TIMESTAMP '2026-02-01 00:00:00 UTC')) / 60 AS INT)").alias("minute")
    silent = found.filter("device_id = 2").select("state", since).collect()
    order = sorted((r["minute"], r["state"]) for r in silent)
    assert order[1:] == [(55, "stale"), (110, "absent"), (200, "fresh"), (245, "stale"), (300, "absent")]
    assert order[0][1] == "fresh"
    assert [r["state"] for r in found.filter("device_id = 1").collect()] == ["fresh"]
