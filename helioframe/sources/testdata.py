"""Telemetry derived from the generic test tables (``events``, ``customer``, ``nation``).

Every event row becomes one raw reading; FIXTURES.md has the rules. Nothing here is part of the
library proper: a real deployment reads its raw tables with ``helioframe.sources.tables``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helioframe.functions.clock import Clock
from helioframe.session import ensure_utc
from helioframe.specs import ANALOG_FIELDS, DEVICE_TYPES

KINDS = ("inverter", "relay", "logger", "tracker", "weather_station", "meter")
VALID_FROM = "2024-01-03 00:00:00"
SECOND_CLOCK = datetime(2024, 1, 15, 12, 10)
LOOKBACK = "24 hours"
STALE_AFTER = "6 hours"
WINDOW = "6 hours"
HORIZON = "10 days"
PLANTS = 25

# Payload keys every device sends, with their text (see FIXTURES.md); {v} is the value with two
# decimals, {k} a number below 100, {tag} the arrival time.
COMMON = (
    ("serial_number", '" SN{device} "'),
    ("active_power", '"{v}@{tag}"'),
    ("irradiance_poa", '"{v}@{tag}"'),
    ("daily_active_energy", '"{v}"'),
    ("posat", '"{v}"'),
    ("string_1_current", '"{v}"'),
    ("cumulative_active_energy", "{v}"),
    ("string_3_current", "{v}"),
    ("state_operation", '"3.0@{tag}"'),
)

# (device type, code, value, type, severity, active); the inverter's communication_failure is left out
# so that the unknown-code path runs.
CATALOG = (
    (1, "2003", 1, "alarm", "high", True),
    (1, "2003", 0, "event", "low", True),
    (1, "2011", 1, "alarm", "medium", True),
    (1, "2011", 0, "event", "low", True),
    (2, "breaker_position", 0, "alarm", "high", True),
    (2, "breaker_position", 1, "event", "low", True),
    (2, "communication_failure", 0, "alarm", "high", True),
    (2, "2003", 1, "alarm", "low", False),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(key: str, template: str) -> str:
    sql = _quoted(f',"{key}":{template}')
    for name, column in (("device", "device_text"), ("v", "v_text"), ("tag", "tag")):
        sql = sql.replace("{" + name + "}", f"' || {column} || '")
    return sql


def extra_fields(kind: str) -> list[str]:
    """Analog fields of a device type that the common payload does not hold."""
    common = {key for key, _ in COMMON} | {"frequency", "state_simplified", "breaker_position"}
    return [name for name, _ in ANALOG_FIELDS[kind] if name not in common]


def payload_sql(kind: str, whole: str, text: str) -> str:
    """SQL for the payload text, for any dialect: ``whole`` divides whole numbers, ``text`` is its type."""
    number = f"CAST({{0}} AS {text})"
    parts = ["'{\"timestamp\":\"' || payload_time || '\"'", *(_filled(key, template) for key, template in COMMON)]
    parts += [
        "CASE k % 10 WHEN 0 THEN ',\"frequency\":\"-\"' WHEN 1 THEN ',\"frequency\":\"\"' WHEN 2 THEN '' "
        f"ELSE ',\"frequency\":\"60.0' || {number.format('k % 10')} || '\"' END",
        f"',\"state_simplified\":\"' || {number.format('k % 4')} || '.0\"'",
        "CASE WHEN k % 7 = 0 THEN ',\"breaker_position\":\"0\"' ELSE ',\"breaker_position\":\"1\"' END",
        "CASE WHEN k % 5 = 0 THEN ',\"flh_com\":\"1\"' ELSE ',\"flh_com\":\"0\"' END",
        f"',\"2003\":\"' || {number.format('k % 2')} || '\"'",
        "CASE WHEN k % 3 = 0 THEN ',\"2011\":true' ELSE ',\"2011\":false' END",
        "',\"61440\":\"1@x\"'",
        "CASE WHEN k % 11 = 0 THEN ',\"communication_failure\":0' ELSE ',\"communication_failure\":1' END",
    ]
    for i, name in enumerate(extra_fields(kind)):
        cents = f"(cents * {i + 2})"
        value = f"{number.format(f'{cents} {whole} 100')} || '.' || lpad({number.format(f'{cents} % 100')}, 2, '0')"
        parts.append(
            f"CASE (k + {i}) % 4 WHEN 0 THEN ',\"{name}\":\"' || {value} || '@' || tag || '\"' "
            f"WHEN 1 THEN ',\"{name}\":\"' || {value} || '\"' WHEN 2 THEN ',\"{name}\":' || {value} "
            f"ELSE CASE WHEN k % 3 = 0 THEN ',\"{name}\":\"-\"' ELSE '' END END"
        )
    return " || ".join([*parts, "'}'"])


class Telemetry:
    """The derived tables of one test-data folder."""

    _limits: dict[str, tuple[datetime, int]] = {}
    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = ensure_utc(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One test table; its schema is taken from the file once, since every look costs a job."""
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def _limit(self) -> tuple[datetime, int]:
        if self.folder not in self._limits:
            row = self.table("events").agg(F.max("ts"), F.max("user_id")).first()
            self._limits[self.folder] = (row[0], row[1])
        return self._limits[self.folder]

    def clock(self) -> Clock:
        """Ten minutes into the last hour that has events."""
        newest, _ = self._limit()
        return Clock(newest.replace(minute=0, second=0, microsecond=0) + timedelta(minutes=10))

    def second_clock(self) -> Clock:
        return Clock(SECOND_CLOCK)

    def raw(self, kind: str) -> DataFrame:
        readings = self.table("events").selectExpr(
            "ts",
            "user_id + 1 AS device_id",
            "CAST(user_id % 6 + 1 AS INT) AS device_type_id",
            f"(user_id DIV 6) % {PLANTS} + 1 AS power_plant_id",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
            "CAST(value AS DECIMAL(18,2)) AS v",
        )
        texts = readings.filter(F.col("device_type_id") == DEVICE_TYPES[kind]).selectExpr(
            "*",
            "CAST(device_id AS STRING) AS device_text",
            "CAST(v AS STRING) AS v_text",
            "CAST(v * 100 AS BIGINT) AS cents",
            "date_format(ts, 'yyyyMMddHHmmss') AS tag",
            "date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS payload_time",
        )
        # A raw table holds its payload as text. The one-element explode keeps it so here: without it
        # Spark would move tests on payload fields below and build the text once more for each.
        return texts.select(
            F.col("ts").cast("timestamp").alias("timestamp"),
            "power_plant_id",
            "device_id",
            F.explode(F.array(F.expr(payload_sql(kind, "DIV", "STRING")))).alias("json_data"),
        )

    def plants(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "CAST(n_nationkey + 1 AS BIGINT) AS id",
            "CAST(n_regionkey AS BIGINT) AS customer_id",
            "n_name AS name",
            "CAST(1000 + 100 * n_nationkey AS DOUBLE) AS capacity",
            "n_name AS location",
            "CAST(NULL AS DOUBLE) AS location_lat",
            "CAST(NULL AS DOUBLE) AS location_long",
            "n_nationkey % 5 <> 4 AS is_active",
        )

    def devices(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey + 1 AS id",
            "CAST(c_custkey % 6 + 1 AS INT) AS device_type_id",
            f"(c_custkey DIV 6) % {PLANTS} + 1 AS power_plant_id",
            "c_name AS device_name",
            "c_custkey % 11 <> 0 AS is_active",
        )

    def catalog(self) -> DataFrame:
        rows = ", ".join(
            f"({i}L, {kind}, '{code}', {value}, '{code} is {value}', '{label}', '{severity}', {str(active).lower()})"
            for i, (kind, code, value, label, severity, active) in enumerate(CATALOG, start=1)
        )
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} "
            "AS c(id, device_type_id, code, value, description, type, severity, is_active)"
        )
