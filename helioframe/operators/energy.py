"""Daily energy series and energy now."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import DAY, Clock, between, interval, time_bucket
from helioframe.operators.dedup import newest_per
from helioframe.operators.latest import since
from helioframe.specs import ENERGY_RECOMPUTE, READING_LOOKBACK

_ENERGY = "decimal(28,2)"


def device_day_energy(analog: DataFrame) -> DataFrame:
    """Highest counter value per device and day; the counter restarts daily, so that is its last one."""
    return (
        analog.filter(F.col("daily_active_energy").isNotNull())
        .groupBy(
            time_bucket("1 day", F.col("timestamp")).cast("date").alias("date"), "power_plant_id", "device_id"
        )
        .agg(F.max("daily_active_energy").alias("daily_active_energy"))
    )


def energy_window(
    analog: DataFrame, clock: Clock, days: str = ENERGY_RECOMPUTE, also: Sequence[date] = ()
) -> DataFrame:
    """Readings of the days that a run recomputes, always whole: the newest ones and those named."""
    start = F.date_trunc("day", F.to_date(clock.utc()).cast("timestamp_ntz") - interval(days)).cast("timestamp_ntz")
    if not also:
        return between(analog, start, closed_lower=True)
    day = F.col(DAY) if DAY in analog.columns else F.to_date("timestamp")
    return analog.filter((day >= F.to_date(start)) | day.isin(*also))


def plant_energy_from_devices(device_days: DataFrame) -> DataFrame:
    """Plant energy per day from per-device rows."""
    return device_days.groupBy("date", "power_plant_id").agg(
        F.sum("daily_active_energy").cast(_ENERGY).alias("total_energy_kwh"),
        F.count("device_id").alias("total_active_inverters"),
    )


def portfolio_from_plants(plant_days: DataFrame) -> DataFrame:
    """Energy per day over all plants; each plant is one row a day, so counting rows counts plants."""
    return plant_days.groupBy("date").agg(
        F.sum("total_energy_kwh").cast(_ENERGY).alias("total_energy_kwh"),
        F.sum("total_active_inverters").alias("total_active_inverters"),
        F.count("power_plant_id").alias("total_power_plants"),
    )


def plant_daily_energy(analog: DataFrame) -> DataFrame:
    """Energy and reporting inverters per plant and day."""
    return plant_energy_from_devices(device_day_energy(analog))


def daily_energy(analog: DataFrame) -> DataFrame:
    """Energy, reporting inverters and plants per day over the whole portfolio."""
    return portfolio_from_plants(plant_daily_energy(analog))


def plant_energy_now(analog: DataFrame, clock: Clock, lookback: str = READING_LOOKBACK) -> DataFrame:
    """Sum per plant of each inverter's newest daily counter that has a value."""
    counted = since(analog, clock, lookback).filter(F.col("daily_active_energy").isNotNull())
    newest = newest_per(
        counted.select("power_plant_id", "device_id", "timestamp", "daily_active_energy"),
        ["device_id"],
        [F.desc("timestamp"), F.asc("power_plant_id")],
    )
    return newest.groupBy("power_plant_id").agg(F.sum("daily_active_energy").cast(_ENERGY).alias("et_kwh"))
