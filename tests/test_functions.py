"""Golden vectors of the column helpers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, LiveClock, payload_local, time_bucket, zone_to_instant
from helioframe.functions.gridvalue import extract_grid_value, grid_value
from helioframe.functions.text import event_id, round2, round2_sql

VALUES = [
    ('"-517996.544@20251130135055"', "FLOAT", -517996.544),
    ('"-517996.544"', "FLOAT", -517996.544),
    ("60.01", "FLOAT", 60.01),
    ('"60.07@2025-12-11T13:50:14Z"', "FLOAT", 60.07),
    ('"1e3"', "FLOAT", 1000.0),
    ('"512.0"', "INTEGER", 512),
    ("512", "INTEGER", 512),
    ('"3@20251130143400"', "INTEGER", 3),
    ('"512.5"', "INTEGER", 513),
    ('"-512.5"', "INTEGER", -513),
    ('"512.5"', "BIGINT", 513),
    ('"7"', "SMALLINT", 7),
    ('"1.005"', "DECIMAL2", Decimal("1.01")),
    ('"1.005"', "NUMERIC", Decimal("1.005")),
    ('"abc@1"', "TEXT", "abc"),
    ("null", "FLOAT", None),
    ('""', "FLOAT", None),
    ('"-"', "FLOAT", None),
    ('"@2025"', "FLOAT", None),
    ('"abc"', "FLOAT", None),
    ('"1d"', "FLOAT", None),
    ('"1f"', "FLOAT", None),
    ('"-"', "TEXT", None),
    ('""', "INTEGER", None),
    ('"99999999999"', "INTEGER", None),
]


def test_grid_values(spark):
    df = spark.createDataFrame([(i, f'{{"f":{json}}}') for i, (json, _, _) in enumerate(VALUES)], "i int, j string")
    for cast_as in sorted({kind for _, kind, _ in VALUES}):
        got = dict(df.select("i", extract_grid_value("j", "f", cast_as)).collect())
        for i, (json, kind, expected) in enumerate(VALUES):
            if kind == cast_as:
                assert got[i] == expected, (json, kind)
    missing = df.select(extract_grid_value("j", "other")).distinct().collect()
    assert missing == [(None,)]
    with pytest.raises(ValueError):
        grid_value("j", "JSON")


def test_rounding_never_fails(spark):
    values = spark.createDataFrame([(1e21,), (float("nan"),), (float("inf"),), (1e17,), (2.345,), (-0.125,)], "v double")
    wanted = [None, None, None, None, Decimal("2.35"), Decimal("-0.13")]
    assert [r[0] for r in values.select(round2(F.col("v"))).collect()] == wanted
    assert [r[0] for r in values.selectExpr(round2_sql("v")).collect()] == wanted


def test_clocks(spark):
    one = spark.range(1)
    clock = Clock(datetime(2025, 12, 11, 13, 50, 14))
    summer = Clock(datetime(2018, 12, 11, 13, 50, 14))
    row = one.select(
        payload_local(F.lit("2025-12-11T13:50:14Z")).alias("payload"),
        payload_local(F.lit("2025-12-11T10:50:14-03:00")).alias("offset"),
        payload_local(F.lit("soon")).alias("bad"),
        payload_local(F.lit("12:30")).alias("time_only"),
        payload_local(F.lit("2026")).alias("year_only"),
        clock.local().alias("local"),
        clock.fixed_local().alias("fixed"),
        summer.local().alias("summer"),
        summer.fixed_local().alias("summer_fixed"),
        zone_to_instant(clock.local()).cast("timestamp_ntz").alias("back"),
        time_bucket("1 day", clock.local()).alias("day"),
        time_bucket("15 minutes", clock.local()).alias("quarter"),
    ).first()
    here = datetime(2025, 12, 11, 10, 50, 14)
    assert row["payload"] == row["offset"] == row["local"] == row["fixed"] == here
    assert row["bad"] is None and row["time_only"] is None and row["year_only"] is None
    # Summer time ran until 2019: the zone moves two hours there, payload times always three.
    assert row["summer"] == datetime(2018, 12, 11, 11, 50, 14)
    assert row["summer_fixed"] == datetime(2018, 12, 11, 10, 50, 14)
    assert row["back"] == datetime(2025, 12, 11, 13, 50, 14)
    assert row["day"] == datetime(2025, 12, 11)
    assert row["quarter"] == datetime(2025, 12, 11, 10, 45)


def test_event_id(spark):
    row = spark.sql("SELECT 1L AS d, TIMESTAMP_NTZ '2026-01-06 10:00:00' AS t, '2003' AS c").select(
        event_id(F.col("d"), F.col("t"), F.col("c"))
    )
    assert row.first()[0] == 515036840010582735


def test_sql_functions_give_what_the_column_form_gives(spark):
    from helioframe.functions.gridvalue import extract_grid_value
    from helioframe.functions.sqlfunctions import PAIRS, TARGETS, register

    names = register(spark)
    assert names == [name for name, _, _ in TARGETS] + [PAIRS]
    texts = ["60.07@2025-12-11T13:50:14Z", "60.07", "-", "", "512.5", "abc", "1d", " 7 ", "99999999999"]
    rows = [(k, f'{{"v":"{text}","n":{k}}}') for k, text in enumerate(texts)] + [(90, None), (91, "no json"), (92, "{}"), (93, '{"v":null}')]
    payloads = spark.createDataFrame(rows, "id int, json_data string")
    payloads.createOrReplaceTempView("payloads")
    for name, target, _ in TARGETS:
        got = spark.sql(f"SELECT id, {name}(json_data, 'v') AS x FROM payloads ORDER BY id")
        wanted = payloads.select("id", extract_grid_value("json_data", "v", target).alias("x")).orderBy("id")
        assert got.collect() == wanted.collect(), name
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    pairs = spark.sql(f"SELECT p.id, g.* FROM payloads p, LATERAL {PAIRS}(p.json_data) g WHERE p.id IN (0, 92, 93) ORDER BY 1, 2 DESC")
    assert [tuple(r) for r in pairs.collect()] == [(0, "v", texts[0]), (0, "n", "0"), (93, "v", None)]


def test_a_view_over_the_live_clock_moves_on(spark):
    live = LiveClock()
    columns = [live.instant(), live.utc(), live.local(), live.fixed_local(), live.today()]
    names = ["instant", "utc", "local", "fixed_local", "today"]
    spark.range(1).select(*(c.alias(n) for c, n in zip(columns, names))).createOrReplaceTempView("live_times")
    first = spark.table("live_times").first()
    now = Clock(datetime.now(timezone.utc))
    near = spark.range(1).select(now.utc().alias("utc"), now.local().alias("local"), now.fixed_local().alias("fixed_local")).first()
    assert all(abs(near[n] - first[n]) < timedelta(minutes=2) for n in ("utc", "local", "fixed_local"))
    assert spark.table("live_times").first()["utc"] > first["utc"]
