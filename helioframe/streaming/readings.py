"""Streaming staging, daily maxima and live state per device.

Event time stays an instant here, because a watermark needs one; the naive local time is derived
beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import LOCAL_OFFSET_HOURS, interval
from helioframe.operators.staging import typed_readings
from helioframe.specs import analog_columns

EVENT_TIME = "event_time"


def stream_analog(raw: DataFrame, kind: str, delay: str = "1 hour") -> DataFrame:
    """Typed readings with one row per device and payload time inside the watermark.

    A stream keeps the first copy it meets, not the newest; the batch form keeps the newest. Use
    ``helioframe.streaming.feed`` where a later copy must win.
    """
    typed = typed_readings(raw, kind).filter(F.col("timestamp").isNotNull())
    timed = typed.withColumn(EVENT_TIME, _instant(F.col("timestamp")))
    return (
        timed.withWatermark(EVENT_TIME, delay)
        .dropDuplicatesWithinWatermark(["device_id", EVENT_TIME])
        .select(EVENT_TIME, *analog_columns(kind))
    )


def _instant(local):
    return local.cast("timestamp") + interval(f"{LOCAL_OFFSET_HOURS} hours")


def stream_device_days(raw: DataFrame, delay: str = "3 days") -> DataFrame:
    """Highest daily counter per inverter and local day, in a tumbling window; for update mode.

    State is one number per device and day that is still inside the watermark, and Spark takes the
    maximum within each task before it shuffles. Duplicates do not change a maximum.
    """
    typed = typed_readings(raw, "inverter")
    # The window runs on local time written as an instant, so that its days are plant days.
    counted = typed.filter(F.col("timestamp").isNotNull() & F.col("daily_active_energy").isNotNull()).select(
        F.col("timestamp").cast("timestamp").alias("local_time"), "power_plant_id", "device_id", "daily_active_energy"
    )
    return (
        counted.withWatermark("local_time", delay)
        .groupBy(F.window("local_time", "1 day").alias("day"), "power_plant_id", "device_id")
        .agg(F.max("daily_active_energy").alias("daily_active_energy"))
        .select(F.to_date("day.start").alias("date"), "power_plant_id", "device_id", "daily_active_energy")
    )


def stream_latest(raw: DataFrame, kind: str) -> DataFrame:
    """Newest reading per device as live state; for update mode.

    A copy with the same payload time wins when it arrived later, as in the batch form.
    """
    typed = typed_readings(raw, kind).filter(F.col("timestamp").isNotNull())
    columns = analog_columns(kind)
    order = F.struct("timestamp", "__arrived_at", "__payload_hash")
    newest = typed.groupBy("device_id").agg(F.max_by(F.struct(*columns), order).alias("r"))
    return newest.select(*(F.col("r")[name].alias(name) for name in columns))
