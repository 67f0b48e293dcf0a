"""Writers on disk: what a second run, a schema change or a late row does to a table."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helioframe.functions.clock import Clock
from helioframe.operators.incremental import incremental_filter, rows_not_in, sync_columns, watermark_of
from helioframe.sources import sinks
from helioframe.sources.control import Positions
from helioframe.sources.tables import read_raw, read_reference, read_table, table_exists
from helioframe.schemas import DEVICES


def readings(spark, *triples):
    made = [(datetime(2026, 2, day, 10, minute), 1, value) for day, minute, value in triples]
    return sinks.with_day(spark.createDataFrame(made, "timestamp timestamp_ntz, device_id bigint, v string"))


def files(df):
    return {row[0] for row in df.select("_metadata.file_path").distinct().collect()}


def test_upsert_replaces_keys_and_leaves_other_days_alone(spark, folder):
    path = folder + "/t"
    assert not table_exists(spark, path)
    sinks.upsert(spark, readings(spark, (1, 0, "a"), (1, 1, "b"), (2, 0, "c")), path, ["device_id", "timestamp"])
    first_day = files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 1)))
    batch = readings(spark, (2, 0, "C"), (2, 1, "d"), (3, 0, "e"))
    sinks.upsert(spark, batch, path, ["device_id", "timestamp"])
    expected = [("C",), ("a",), ("b",), ("d",), ("e",)]
    assert rows(read_table(spark, path), "v") == expected
    assert files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 1))) == first_day
    sinks.upsert(spark, batch, path, ["device_id", "timestamp"])
    assert rows(read_table(spark, path), "v") == expected
    third = files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 3)))
    sinks.upsert(spark, readings(spark, (3, 5, "f")), path, ["device_id", "timestamp"])
    # New keys only: the day is added to, not rewritten.
    assert third < files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 3)))


def test_a_batch_delivered_again_writes_nothing(spark, folder):
    path = folder + "/t"
    batch = readings(spark, (1, 0, "a"), (1, 1, None), (2, 0, "c"))
    sinks.upsert(spark, batch, path, ["device_id", "timestamp"])
    kept = files(read_table(spark, path))
    seen = []
    sinks.upsert(spark, batch, path, ["device_id", "timestamp"], on_change=lambda rows: seen.append(rows.count()))
    assert files(read_table(spark, path)) == kept and seen == [0]


def test_append_replace_and_schema_guard(spark, folder):
    path = folder + "/t"
    sinks.create_partitioned(readings(spark, (1, 0, "a"), (2, 0, "b")), path)
    sinks.append(spark, readings(spark, (2, 0, "b")), path)
    assert rows(read_table(spark, path), "v") == [("a",), ("b",), ("b",)]
    sinks.replace_partitions(spark, readings(spark, (2, 9, "z")), path)
    assert rows(read_table(spark, path), "v") == [("a",), ("z",)]
    wider = readings(spark, (3, 0, "c")).withColumn("w", F.lit(1))
    for write in (sinks.append, sinks.replace_partitions):
        with pytest.raises(ValueError, match="schema drift"):
            write(spark, wider, path)
    with pytest.raises(ValueError, match="schema drift"):
        sinks.upsert(spark, wider, path, ["device_id", "timestamp"])


def test_sync_adds_and_drops_columns(spark, folder):
    path = folder + "/t"
    sinks.create_partitioned(readings(spark, (1, 0, "a")), path)
    changed = readings(spark, (2, 0, "b")).select("timestamp", "device_id", F.lit(5).alias("w"), "date")
    assert sync_columns(read_table(spark, path), changed).columns == changed.columns
    sinks.upsert(spark, changed, path, ["device_id", "timestamp"], on_schema_change="sync")
    assert sorted(read_table(spark, path).columns) == ["date", "device_id", "timestamp", "w"]
    assert rows(read_table(spark, path), "date", "w") == [(date(2026, 2, 1), None), (date(2026, 2, 2), 5)]


def test_watermarks(spark, folder):
    df = readings(spark, (1, 0, "a"), (1, 1, "b"), (2, 0, "c"))
    assert watermark_of(df) == datetime(2026, 2, 2, 10, 0)
    assert incremental_filter(df, None).count() == 3
    assert watermark_of(df.limit(0)) is None
    mark = datetime(2026, 2, 1, 10, 0)
    assert rows(incremental_filter(df, mark), "v") == [("b",), ("c",)]
    assert rows(incremental_filter(df, mark, allowed_lateness="1 hour"), "v") == [("a",), ("b",), ("c",)]
    assert rows(rows_not_in(df, df.filter("v = 'a'"), ["device_id", "timestamp"]), "v") == [("b",), ("c",)]

    positions = Positions(spark, folder + "/positions")
    assert positions.read("x") is None
    positions.write("x", mark)
    positions.write("x", datetime(2026, 1, 1))
    positions.write("y", mark)
    positions.compact()
    assert positions.read("x") == datetime(2026, 1, 1)
    assert positions.read("y") == mark


def test_a_time_bound_prunes_days(spark, folder):
    path = folder + "/t"
    sinks.create_partitioned(readings(spark, *((d, 0, str(d)) for d in range(1, 20))), path)
    kept = incremental_filter(read_table(spark, path), datetime(2026, 2, 17, 10, 0))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(kept, "v") == [("18",), ("19",)]


def test_compaction_is_clustered_and_bounded(spark, folder):
    path = folder + "/t"
    sinks.create_partitioned(readings(spark, (1, 0, "a"), (2, 0, "b"), (20, 0, "c")), path)
    for minute in (1, 2, 3):
        sinks.append(spark, readings(spark, (1, minute, "x"), (20, minute, "x")), path)
    many = len(files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 20))))
    assert sinks.compact(spark, path, Clock(datetime(2026, 2, 21, 12)), days=20) == ["2026-02-01", "2026-02-02"]
    assert len(files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 1)))) == 1
    assert len(files(read_table(spark, path).filter(F.col("date") == date(2026, 2, 20)))) == many
    assert read_table(spark, path).count() == 9
    assert sinks.drop_expired(spark, path, Clock(datetime(2026, 2, 21, 12)), "10 days") == ["2026-02-01", "2026-02-02"]
    assert read_table(spark, path).count() == 4


def test_readers(spark, folder):
    raw = folder + "/raw"
    line = '{"timestamp":"2026-02-01T10:00:00Z","power_plant_id":1,"device_id":2,"json_data":{"timestamp":"t","a":1}}'
    spark.createDataFrame([(line,)], "value string").write.text(raw)
    row = read_raw(spark, raw, "json").first()
    assert row["json_data"] == '{"timestamp":"t","a":1}'
    sinks.refresh(spark, spark.sql("SELECT 1 AS id, 2 AS device_type_id, 3 AS power_plant_id"), folder + "/devices")
    devices = read_reference(spark, folder + "/devices", DEVICES)
    assert [f.dataType for f in devices.schema] == [f.dataType for f in DEVICES]
