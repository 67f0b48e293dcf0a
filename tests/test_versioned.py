"""Versioned tables: a write that stops anywhere leaves the old table or the new one, and rewrites little."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from helioframe.sources import files, sinks, versioned
from helioframe.sources.tables import read_table, table_exists
from helioframe.sources.versioned import Table

KEY = ["device_id", "timestamp"]
DAYS = ("2026-02-01", "2026-02-02")


def readings(spark, version="a", devices=range(40), days=(1, 2)):
    made = [(datetime(2026, 2, day, 10) + timedelta(minutes=d), d, f"{version}{d}") for day in days for d in devices]
    return sinks.with_day(spark.createDataFrame(made, "timestamp timestamp_ntz, device_id bigint, v string"))


@pytest.fixture()
def table(spark, folder):
    made = Table(spark, f"{folder}/t", bucket_by=KEY, buckets=8)
    made.create(readings(spark))
    return made


def stored_files(df):
    return {row[0] for row in df.select("_metadata.file_path").distinct().collect()}


def test_a_changed_reading_rewrites_one_bucket(spark, table):
    before, leaves = stored_files(table.read()), set(table.leaves())
    assert len(leaves) == 16
    table.upsert(readings(spark, "b", [7], [2]), KEY)
    kept = before & stored_files(table.read())
    assert len(kept) == len(before) - 1
    assert len(leaves - set(table.leaves())) == 1
    assert rows(table.read().filter("v LIKE 'b%'"), "device_id", "v") == [(7, "b7")]
    assert table.read().count() == 80
    # New keys alone rewrite nothing, and a batch delivered again writes nothing.
    before, version = stored_files(table.read()), table.version()
    table.upsert(readings(spark, "c", range(100, 105)), KEY)
    assert before < stored_files(table.read()) and table.version() == version + 1
    table.upsert(readings(spark, "c", range(100, 105)), KEY)
    assert table.version() == version + 1 and table.read().count() == 90


class Stopped(Exception):
    pass


#: Where a write can stop: before its job, in the middle of it, after it, before and after the rename of the version.
STOPS = ("before job", "in job", "after job", "before rename", "after rename")


def stopping(monkeypatch, step):
    put, publish = Table._put, Table._publish

    def stopped_put(self, df, state):
        if step == "before job":
            raise Stopped
        if step == "in job":
            broken = df.withColumn("device_id", F.when(F.col("device_id") % 3 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("device_id")))
            return put(self, broken, state)
        done = put(self, df, state)
        if step == "after job":
            raise Stopped
        return done

    def stopped_publish(self, state):
        if step == "before rename":
            files.write_new(self.spark, f"{self.root}/_versions/.draft-left", "{")
            raise Stopped
        publish(self, state)
        if step == "after rename":
            raise Stopped

    monkeypatch.setattr(Table, "_put", stopped_put)
    monkeypatch.setattr(Table, "_publish", stopped_publish)


WRITES = {
    "upsert": lambda t, df: t.upsert(df, KEY),
    "create": lambda t, df: t.create(df),
    "replace": lambda t, df: t.replace(df, gone=lambda value: value > DAYS[0]),
    "append": lambda t, df: t.append(df),
}


@pytest.mark.parametrize("write", WRITES)
def test_a_write_that_stops_leaves_the_old_table_or_the_new(spark, table, monkeypatch, write):
    batch = readings(spark, "b", range(3, 60, 3), [2])
    old = rows(table.read())
    done = Table(spark, f"{table.root}-done", bucket_by=KEY, buckets=8)
    done.create(readings(spark))
    WRITES[write](done, batch)
    new = rows(done.read())
    for step in STOPS:
        with monkeypatch.context() as patched:
            stopping(patched, step)
            with pytest.raises(Exception):  # noqa: B017, PT011 - a lost job shows as a Spark error
                WRITES[write](table, batch)
        assert rows(read_table(spark, table.root)) == (new if step == "after rename" else old), step
    # What stopped writes left is unknown to readers and goes with the next cleaning.
    table.vacuum(0)
    assert rows(table.read()) == new
    live = {write for write, _ in table.leaves()}
    assert {name.split("=")[1] for name in files.child_folders(spark, f"{table.root}/data")} == live


def test_cleaning_that_stops_keeps_the_table(spark, table, monkeypatch):
    for version in "bc":
        table.upsert(readings(spark, version), KEY)
    new, calls = rows(table.read()), []

    def stopped(session, path):
        calls.append(path)
        if len(calls) % 2:
            return files.delete_path(session, path)
        raise Stopped

    for _ in range(3):
        with monkeypatch.context() as patched:
            patched.setattr(versioned, "delete_path", stopped)
            with pytest.raises(Stopped):
                table.vacuum(0)
        assert rows(table.read()) == new
    assert table.vacuum(3600) == [] and rows(table.read()) == new
    table.vacuum(0)
    assert rows(table.read()) == new


def test_two_writers_cannot_publish_the_same_version(spark, table):
    state = table._state()
    table.append(readings(spark, "b", [100]))
    with pytest.raises(Exception, match="exist"):
        table._publish(state)
    assert table.read().count() == 82


def test_readers_keep_the_version_they_opened(spark, table):
    opened, held = table.read(), rows(table.read())
    table.create(readings(spark, "z", [1]))
    assert rows(opened) == held
    assert table.read().count() == 2


def test_columns_change_without_touching_files(spark, table):
    before = stored_files(table.read())
    wider = readings(spark, "b", [1], [3]).withColumn("w", F.lit(5)).drop("v")
    with pytest.raises(ValueError, match="schema drift"):
        table.upsert(wider, KEY)
    table.upsert(wider, KEY, on_schema_change="sync")
    assert before < stored_files(table.read())
    assert sorted(table.read().columns) == ["date", "device_id", "timestamp", "w"]
    assert rows(table.read().groupBy("w").count()) == [(1, 5), (80, None)]
    # A name that comes back, or comes with another type, does not bring old values back.
    table.evolve(readings(spark).schema)
    assert rows(table.read().groupBy("v").count()) == [(81, None)]
    table.evolve(T.StructType([f if f.name != "v" else T.StructField("v", T.LongType()) for f in table.schema()]))
    table.append(readings(spark, "", [200], [4]).withColumn("v", F.col("v").cast("long")))
    assert rows(table.read().filter("v IS NOT NULL"), "v") == [(200,)]
    assert before < stored_files(table.read())


def test_days_compaction_and_tables_without_days(spark, folder, table):
    for version in "bcd":
        table.append(readings(spark, version, range(300, 304), [1]))
    held = rows(table.read())
    table.compact([DAYS[0]])
    assert rows(table.read()) == held and table.partitions() == list(DAYS)
    assert len({write for write, leaf in table.leaves() if DAYS[0] in leaf}) == 1
    plan = table.read().filter("date = DATE'2026-02-02'")._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    table.drop_partitions([DAYS[0]])
    assert table.partitions() == [DAYS[1]] and table.read().count() == 40

    flat = Table(spark, f"{folder}/flat", None)
    assert not flat.exists() and not table_exists(spark, flat.root)
    flat.create(spark.range(3))
    flat.upsert(spark.createDataFrame([(2,), (9,)], "id long"), ["id"])
    assert rows(read_table(spark, flat.root)) == [(0,), (1,), (2,), (9,)]
    flat.create(flat.read().filter("id > 1"))
    assert rows(flat.read()) == [(2,), (9,)]
    nothing = Table(spark, f"{folder}/nothing", bucket_by=KEY, buckets=8)
    nothing.create(readings(spark).limit(0))
    assert nothing.read().count() == 0 and not table_exists(spark, nothing.root)
    nothing.upsert(readings(spark), KEY)
    assert nothing.read().count() == 80


def test_null_days_and_helper_names(spark, folder):
    made = [(None, 1, 2), (None, 2, 3)]
    schema = "date date, bucket long, write long"
    table = Table(spark, f"{folder}/odd", bucket_by=["bucket"], buckets=4)
    table.create(spark.createDataFrame(made, schema))
    table.upsert(spark.createDataFrame([(None, 2, 30), (None, 3, 4)], schema), ["bucket"])
    assert rows(table.read(), "bucket", "write") == [(1, 2), (2, 30), (3, 4)]
    assert rows(table.read().filter("date IS NULL"), "bucket") == [(1,), (2,), (3,)]
