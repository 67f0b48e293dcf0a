"""Share of a plant's devices that are working now."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, interval
from helioframe.functions.gridvalue import extract_grid_value
from helioframe.operators.latest import newest_reading
from helioframe.specs import DEVICE_TYPES, READING_LOOKBACK, STALE_AFTER


@dataclass(frozen=True)
class ActiveRule:
    """Name used in the output columns, and the test a reading must pass to count as working."""

    plural: str
    test: Callable[[], Column]


def _discrete(name: str) -> Column:
    return extract_grid_value("discrete_data_json", name, "INTEGER")


# An inverter produces in state 2; a relay is fine with its breaker closed (1) and no
# communication failure (1 means none); a tracker is fine with flh_com 0.
ACTIVE_RULES = {
    "inverter": ActiveRule("inverters", lambda: F.col("state_simplified") == 2),
    "relay": ActiveRule("relays", lambda: (_discrete("breaker_position") == 1) & (_discrete("communication_failure") == 1)),
    "tracker": ActiveRule("trackers", lambda: _discrete("flh_com") == 0),
}


def registered_devices(devices: DataFrame, plants: DataFrame, kind: str) -> DataFrame:
    """Active devices of one type in active plants."""
    active_plants = plants.filter("is_active").select(F.col("id").alias("power_plant_id"))
    ours = devices.filter((F.col("device_type_id") == DEVICE_TYPES[kind]) & F.col("is_active"))
    return ours.join(active_plants, "power_plant_id")


def device_staleness(
    devices: DataFrame,
    plants: DataFrame,
    readings: DataFrame,
    kind: str,
    clock: Clock,
    *,
    lookback: str = READING_LOOKBACK,
    stale_after: str = STALE_AFTER,
) -> DataFrame:
    """Each registered device as fresh, stale (heard inside the look-back, but not lately) or absent."""
    newest = newest_reading(readings.select("device_id", "power_plant_id", "timestamp"), clock, lookback)
    heard = newest.select("device_id", F.col("timestamp").alias("last_reading"))
    ours = registered_devices(devices, plants, kind).select(F.col("id").alias("device_id"), "power_plant_id")
    state = F.when(F.col("last_reading").isNull(), "absent").when(F.col("last_reading") > clock.local() - interval(stale_after), "fresh")
    return ours.join(heard, "device_id", "left").select("device_id", "power_plant_id", "last_reading", state.otherwise("stale").alias("state"))


def availability(
    devices: DataFrame,
    plants: DataFrame,
    readings: DataFrame,
    kind: str,
    clock: Clock,
    *,
    lookback: str = READING_LOOKBACK,
    stale_after: str = STALE_AFTER,
    restrict_to_registered: bool = False,
) -> DataFrame:
    """Working, stopped and silent devices per plant, and the working share in percent.

    Readings of devices that are not registered count unless ``restrict_to_registered``.
    """
    rule = ACTIVE_RULES[kind]
    registered = registered_devices(devices, plants, kind)
    totals = registered.groupBy("power_plant_id").agg(F.count("*").alias("total"))
    if restrict_to_registered:
        readings = readings.join(registered.select(F.col("id").alias("device_id")), "device_id", "left_semi")

    fresh_after = clock.local() - interval(stale_after)
    status = newest_reading(readings, clock, lookback).select(
        "power_plant_id",
        F.coalesce(rule.test() & (F.col("timestamp") > fresh_after), F.lit(False)).alias("is_active"),
        (F.col("timestamp") <= fresh_after).alias("is_stale"),
    )
    counts = status.groupBy("power_plant_id").agg(
        F.count_if("is_active").alias("active"),
        F.count_if(~F.col("is_active") & ~F.col("is_stale")).alias("inactive"),
    )
    active, inactive = (F.coalesce(name, F.lit(0)) for name in ("active", "inactive"))
    share = F.round((active * 100).cast("decimal(20,2)") / F.nullif("total", F.lit(0)).cast("decimal(20,0)"), 2)
    return totals.join(counts, "power_plant_id", "left").select(
        "power_plant_id",
        F.col("total").alias(f"total_{rule.plural}"),
        active.alias(f"active_{rule.plural}"),
        inactive.alias(f"inactive_{rule.plural}"),
        (F.col("total") - active - inactive).alias(f"no_data_{rule.plural}"),
        share.cast("decimal(18,2)").alias("availability_pct"),
    )
