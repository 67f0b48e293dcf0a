"""Declared input schemas."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("power_plant_id", T.LongType(), False),
        T.StructField("device_id", T.LongType(), False),
        T.StructField("json_data", T.StringType(), False),
    ]
)

POWER_PLANTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("capacity", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_long", T.DoubleType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

DEVICES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("device_type_id", T.IntegerType(), False),
        T.StructField("power_plant_id", T.LongType(), False),
        T.StructField("device_name", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

EVENT_ALARM_CATALOG = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("device_type_id", T.IntegerType(), False),
        T.StructField("code", T.StringType(), False),
        T.StructField("value", T.IntegerType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)
