"""The documented everyday questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, between, interval

_SHOWN = ["timestamp", "device_id", "active_power", "efficiency", "temperature_internal"]


def device_history(analog: DataFrame, device_id: int, clock: Clock, lookback: str = "24 hours") -> DataFrame:
    """Readings of one device, newest first."""
    ours = between(analog.filter(F.col("device_id") == device_id), clock.local() - interval(lookback), closed_lower=True)
    return ours.select(*_SHOWN).orderBy(F.desc("timestamp"))


def newest_readings(analog: DataFrame, count: int = 10) -> DataFrame:
    """The newest readings of any device; planned as a top-k per task, not a sort."""
    return analog.select(*_SHOWN).orderBy(F.desc("timestamp"), F.asc("device_id")).limit(count)


def last_processed(table: DataFrame) -> DataFrame:
    return table.agg(F.max("timestamp").alias("last_processed"))


def daily_counts(analog: DataFrame, days: int = 7) -> DataFrame:
    """Rows and devices per day, for the newest days."""
    per_day = analog.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("records"), F.countDistinct("device_id").alias("devices")
    )
    return per_day.orderBy(F.desc("day")).limit(days)
