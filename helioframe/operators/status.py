"""Plant status, in the two vocabularies dashboards use."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, between, interval
from helioframe.operators.dedup import newest_per
from helioframe.specs import COMMUNICATION_WINDOW


def active_plants(plants: DataFrame) -> DataFrame:
    return plants.filter("is_active")


def window_start(clock: Clock, window: str = COMMUNICATION_WINDOW) -> Column:
    """The time after which readings and events count for the status."""
    return clock.fixed_local() - interval(window)


def plant_status(
    analog_by_kind: Mapping[str, DataFrame],
    events: DataFrame,
    plants: DataFrame,
    clock: Clock,
    window: str = COMMUNICATION_WINDOW,
) -> DataFrame:
    """Three-state status: a recent high alarm beats silence, silence beats normal operation."""
    after = window_start(clock, window)

    def heard(kind: str, df: DataFrame) -> DataFrame:
        return between(df, after).select("power_plant_id", "timestamp", F.lit(kind).alias("device_type"))

    messages = reduce(DataFrame.unionByName, (heard(kind, df) for kind, df in analog_by_kind.items()))
    communication = messages.groupBy("power_plant_id").agg(
        F.max("timestamp").alias("last_communication_timestamp"),
        F.countDistinct("device_type").alias("heard_types"),
    )
    critical = (
        between(events, after)
        .filter("type = 'alarm' AND severity = 'high'")
        .select("power_plant_id")
        .distinct()
        .withColumn("critical", F.lit(True))
    )
    base = active_plants(plants).select(F.col("id").alias("power_plant_id"))
    joined = base.join(communication, "power_plant_id", "left").join(critical, "power_plant_id", "left")
    alarmed = F.coalesce("critical", F.lit(False))
    return joined.select(
        "power_plant_id",
        F.when(alarmed, "offline")
        .when(F.col("heard_types").isNull(), "no_communication")
        .otherwise("generating")
        .alias("power_plant_status"),
        "last_communication_timestamp",
        F.coalesce("heard_types", F.lit(0)).alias("devices_communicating"),
        alarmed.alias("has_critical_alarm"),
        clock.instant().alias("calculated_at"),
    )


def current_alarm_states(events: DataFrame) -> DataFrame:
    """Newest event of each plant, device and code."""
    columns = ["power_plant_id", "device_id", "code", "type", "severity", "acknowledged", "timestamp"]
    return newest_per(
        events.select(*columns, "id"), ["power_plant_id", "device_id", "code"], [F.desc("timestamp"), F.desc("id")]
    ).select(*columns)


def alarm_status(events: DataFrame) -> DataFrame:
    """Plants whose current states include a high alarm, and whether one is unacknowledged."""
    high = current_alarm_states(events).filter("type = 'alarm' AND severity = 'high'")
    return high.groupBy("power_plant_id").agg(
        F.bool_or(~F.col("acknowledged")).alias("has_unacknowledged_alarm"),
        F.bool_or(F.lit(True)).alias("has_high_alarm"),
    )


def recent_communication(latest_long: DataFrame, clock: Clock, window: str = COMMUNICATION_WINDOW) -> DataFrame:
    """Newest inverter reading per plant inside the window."""
    recent = between(latest_long, clock.fixed_local() - interval(window))
    return recent.groupBy("power_plant_id").agg(F.max("timestamp").alias("last_communication"))


def operating_status(plants: DataFrame, alarms: DataFrame, communication: DataFrame) -> DataFrame:
    """Four-state status of each active plant: silence beats alarms, open alarms beat acknowledged ones."""
    base = active_plants(plants).select(F.col("id").alias("power_plant_id"))
    joined = base.join(alarms, "power_plant_id", "left").join(communication, "power_plant_id", "left")
    return joined.select(
        "power_plant_id",
        F.when(F.col("last_communication").isNull(), "no_communication")
        .when(F.col("has_unacknowledged_alarm"), "critical")
        .when(F.col("has_high_alarm"), "acknowledged")
        .otherwise("generating")
        .alias("power_plant_status"),
    )
