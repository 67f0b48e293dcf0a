"""One row per active plant with everything a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock
from helioframe.functions.text import round2
from helioframe.operators.dedup import newest_per
from helioframe.operators.energy import plant_energy_now
from helioframe.operators.performance import active_power_by_plant, daily_irradiation, performance_ratio
from helioframe.operators.status import alarm_status, operating_status, recent_communication
from helioframe.specs import COMMUNICATION_WINDOW, EXCLUDED_IRRADIANCE_DEVICES, READING_LOOKBACK


def _newest_of_plant(readings: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Several devices of a plant would repeat its row; keep the newest reading of each plant."""
    newest = newest_per(readings, ["power_plant_id"], [F.desc("timestamp"), F.asc("device_id")])
    return newest.select("power_plant_id", *(F.col(old).alias(new) for old, new in columns.items()))


def plants_overview(
    plants: DataFrame,
    weather_latest: DataFrame,
    inverter_availability: DataFrame,
    relay_availability: DataFrame,
    events: DataFrame,
    inverter_latest: DataFrame,
    inverter_analog: DataFrame,
    weather_analog: DataFrame,
    clock: Clock,
    *,
    meter_latest: DataFrame | None = None,
    logger_latest: DataFrame | None = None,
    lookback: str = READING_LOOKBACK,
    window: str = COMMUNICATION_WINDOW,
    exclude_devices: tuple[int, ...] = EXCLUDED_IRRADIANCE_DEVICES,
    report_daily_energy: bool = True,
) -> DataFrame:
    """Power, energy, irradiance, availability, status and Performance Ratio of each active plant.

    Every joined frame is one row per plant and comes partitioned by plant from its own aggregation.
    Meter and logger readings are optional; their times are NULL without them.
    """
    base = plants.filter("is_active").select(
        F.col("id").alias("power_plant_id"),
        F.col("name").alias("power_plant_name"),
        F.col("capacity").alias("rated_power_kw"),
        "location",
    )
    status = operating_status(plants, alarm_status(events), recent_communication(inverter_latest, clock, window))
    sides = [
        _newest_of_plant(
            weather_latest, {"irradiance_poa": "irradiance_poa", "timestamp": "weather_last_reading_timestamp"}
        ),
        inverter_availability.select("power_plant_id", F.col("availability_pct").alias("inverter_pct")),
        relay_availability.select("power_plant_id", F.col("availability_pct").alias("relay_pct")),
        status,
        active_power_by_plant(inverter_latest).withColumnRenamed("active_power_kw", "power_sum"),
        plant_energy_now(inverter_analog, clock, lookback),
        daily_irradiation(weather_analog, clock, exclude_devices=exclude_devices),
    ]
    for name, readings in (("meter", meter_latest), ("logger", logger_latest)):
        if readings is not None:
            sides.append(_newest_of_plant(readings, {"timestamp": f"{name}_last_reading_timestamp"}))
    joined = base
    for side in sides:
        joined = joined.join(side, "power_plant_id", "left")
    for name in ("meter", "logger"):
        column = f"{name}_last_reading_timestamp"
        if column not in joined.columns:
            joined = joined.withColumn(column, F.lit(None).cast("timestamp_ntz"))

    zero = F.lit(0).cast("decimal(28,2)")
    state = F.coalesce("power_plant_status", F.lit("no_communication"))
    energy = round2(F.coalesce("et_kwh", zero)) if report_daily_energy else F.lit(None).cast("decimal(18,2)")
    return joined.select(
        "power_plant_id",
        "power_plant_name",
        "rated_power_kw",
        F.when(state == "no_communication", zero).otherwise(F.coalesce("power_sum", zero)).alias("active_power_kw"),
        energy.alias("daily_energy_kwh"),
        round2(F.coalesce("irradiance_poa", zero)).alias("irradiance_wm2"),
        F.coalesce("inverter_pct", F.lit(0)).cast("decimal(18,2)").alias("inverter_availability_pct"),
        F.coalesce("relay_pct", F.lit(0)).cast("decimal(18,2)").alias("rates_availability_pct"),
        state.alias("power_plant_status"),
        performance_ratio(F.col("et_kwh"), F.col("rated_power_kw"), F.col("ht_kwh_m2")).alias("pr_pct"),
        "location",
        "meter_last_reading_timestamp",
        "logger_last_reading_timestamp",
        "weather_last_reading_timestamp",
        clock.instant().alias("updated_at"),
    )
