"""Newest reading per device, wide or as labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, between, interval
from helioframe.functions.text import round2_sql
from helioframe.operators.dedup import newest_per
from helioframe.specs import INVERTER_DISPLAY, READING_LOOKBACK, analog_columns


def since(df: DataFrame, clock: Clock | None, lookback: str | None) -> DataFrame:
    """Rows newer than the look-back; all rows when none is given."""
    if lookback is None:
        return df
    if clock is None:
        raise ValueError("a look-back needs a clock")
    return between(df, clock.local() - interval(lookback))


def newest_reading(readings: DataFrame, clock: Clock | None = None, lookback: str | None = None) -> DataFrame:
    recent = since(readings, clock, lookback)
    return newest_per(recent, ["device_id"], [F.desc("timestamp"), F.asc("power_plant_id")])


def latest_readings(
    analog: DataFrame, kind: str, clock: Clock | None = None, lookback: str | None = None
) -> DataFrame:
    """All analog columns of each device's newest reading."""
    _, *others = analog_columns(kind)
    columns = ["device_id", "power_plant_id", "timestamp", *(c for c in others if c not in ("power_plant_id", "device_id"))]
    return newest_reading(analog.select(*_with_day(analog, columns)), clock, lookback).select(*columns)


def _with_day(df: DataFrame, columns: list[str]) -> list[str]:
    return [*columns, *(c for c in ("date",) if c in df.columns)]


def merge_latest(previous: DataFrame, batch: DataFrame) -> DataFrame:
    """Newest reading per device over a stored result and a new batch.

    Gives what a pass over the whole history would, at the cost of the devices plus the batch. When
    both hold the same time, the batch has the newer arrival.
    """
    columns = previous.columns
    both = previous.withColumn("__fresh", F.lit(0)).unionByName(batch.select(*columns).withColumn("__fresh", F.lit(1)))
    return newest_per(both, ["device_id"], [F.desc("timestamp"), F.desc("__fresh")]).select(*columns)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _labelled(display: tuple[tuple[str, str, str], ...]) -> Column:
    """All shown fields of a reading as an array, so that one explode makes them rows."""
    fields = (
        f"struct({_quoted(label)} AS field_name, {round2_sql(column)} AS value_numeric, "
        f"{_quoted(unit)} AS unit, {place} AS display_order)"
        for place, (label, column, unit) in enumerate(display, start=1)
    )
    return F.expr("array(" + ", ".join(fields) + ")")


def latest_readings_long(
    analog: DataFrame,
    clock: Clock,
    lookback: str = READING_LOOKBACK,
    display: tuple[tuple[str, str, str], ...] = INVERTER_DISPLAY,
) -> DataFrame:
    """Newest inverter readings, one row per field that has a value, ready to show."""
    newest = newest_reading(analog, clock, lookback)
    rows = newest.select("device_id", "power_plant_id", "timestamp", F.explode(_labelled(display)).alias("f"))
    return rows.filter(F.col("f.value_numeric").isNotNull()).select(
        "device_id",
        "power_plant_id",
        F.col("f.field_name").alias("field_name"),
        F.col("f.value_numeric").alias("value_numeric"),
        F.concat(F.col("f.value_numeric").cast("string"), F.lit(" "), F.col("f.unit")).alias("value_formatted"),
        F.col("f.unit").alias("unit"),
        "timestamp",
        F.col("f.display_order").alias("display_order"),
    )

