"""Power, irradiation and Performance Ratio per plant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, between, interval
from helioframe.functions.text import round2
from helioframe.specs import (
    EXCLUDED_IRRADIANCE_DEVICES,
    IRRADIANCE_SAMPLES_PER_HOUR,
    REFERENCE_IRRADIANCE,
)


def active_power_by_plant(latest_long: DataFrame) -> DataFrame:
    """Sum of the inverters' newest active power."""
    power = latest_long.filter((F.col("field_name") == "Active Power") & F.col("value_numeric").isNotNull())
    return power.groupBy("power_plant_id").agg(F.sum("value_numeric").cast("decimal(28,2)").alias("active_power_kw"))


def daily_irradiation(
    weather: DataFrame,
    clock: Clock,
    *,
    exclude_devices: Sequence[int] = EXCLUDED_IRRADIANCE_DEVICES,
    samples_per_hour: int = IRRADIANCE_SAMPLES_PER_HOUR,
) -> DataFrame:
    """Plane-of-array irradiation of the clock's local day, from evenly spaced samples."""
    midnight = clock.today().cast("timestamp_ntz")
    today = between(weather, midnight, midnight + interval("1 day"), closed_lower=True)
    measured = today.filter(F.col("irradiance_poa").isNotNull())
    if exclude_devices:
        measured = measured.filter(~F.col("device_id").isin(*exclude_devices))
    return measured.groupBy("power_plant_id").agg(
        (F.sum("irradiance_poa").cast("double") / F.lit(float(samples_per_hour))).alias("ht_kwh_m2")
    )


def performance_ratio(energy: Column, rated_power: Column, irradiation: Column) -> Column:
    """Energy delivered against what the rated power would give under the day's irradiation, percent."""
    ratio = (
        (F.coalesce(energy, F.lit(0)).cast("double") / rated_power.cast("double"))
        * (F.lit(REFERENCE_IRRADIANCE) / irradiation.cast("double"))
        * F.lit(100.0)
    )
    return F.when((rated_power > 0) & (F.coalesce(irradiation, F.lit(0.0)) > 0), round2(ratio))


def performance_ratio_by_plant(plants: DataFrame, energy_now: DataFrame, irradiation: DataFrame) -> DataFrame:
    """Performance Ratio of each active plant, with its inputs."""
    base = plants.filter("is_active").select(F.col("id").alias("power_plant_id"), F.col("capacity").alias("rated_power_kw"))
    joined = base.join(energy_now, "power_plant_id", "left").join(irradiation, "power_plant_id", "left")
    return joined.select(
        "power_plant_id",
        "rated_power_kw",
        "et_kwh",
        "ht_kwh_m2",
        performance_ratio(F.col("et_kwh"), F.col("rated_power_kw"), F.col("ht_kwh_m2")).alias("pr_pct"),
    )
