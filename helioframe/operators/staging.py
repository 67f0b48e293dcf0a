"""Raw payloads to typed, deduplicated readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import between, naive_timestamp, payload_local
from helioframe.functions.gridvalue import grid_value, grid_value_sql, payload_struct, payload_typed, typed_text
from helioframe.operators.dedup import newest_per
from helioframe.specs import (
    ANALOG_FIELDS,
    DECIMAL2,
    DISCRETE_RULES,
    IDS,
    INTEGER,
    STRINGS_PER_INVERTER,
    TEXT_FIELDS,
    DiscreteRule,
    analog_columns,
)

_ARRIVED = "__arrived_at"
_TIE = "__payload_hash"
_READABLE = "__readable"
_KEY = ("device_id", "timestamp")


def _arrival_columns() -> list[Column]:
    # The hash makes the winner the same on every run when two copies arrive at the same moment.
    return [F.col("timestamp").alias(_ARRIVED), F.xxhash64("json_data").alias(_TIE)]


def _newest_arrival(readings: DataFrame) -> DataFrame:
    """One row per device and payload time; the newest arrival wins.

    Rows without a readable payload time are dropped here, on a column that is no window key, because
    a test on the key itself would move below the parse and make Spark read every payload twice.
    """
    order = [F.desc(_ARRIVED), F.desc(_TIE)]
    return newest_per(
        readings.withColumn(_READABLE, F.col("timestamp").isNotNull()), _KEY, order, where=F.col(_READABLE)
    )


def typed_readings(raw: DataFrame, kind: str) -> DataFrame:
    """Payload fields as typed columns, one parse per row, duplicates still in."""
    numbers = ANALOG_FIELDS[kind]
    texts = TEXT_FIELDS.get(kind, ())
    fields = ["timestamp", *texts, *(name for name, _ in numbers)]
    parsed = raw.select(
        *_arrival_columns(), "power_plant_id", "device_id", payload_struct(F.col("json_data"), fields).alias("p")
    )
    timed = parsed.withColumn("timestamp", payload_local(F.col("p.timestamp")))
    return timed.selectExpr(
        _ARRIVED,
        _TIE,
        *IDS,
        *(f"nullif(trim(p.{name}), '') AS {name}" for name in texts),
        *(f"{grid_value_sql(f'p.{name}', target)} AS {name}" for name, target in numbers),
    )


def stage_analog(raw: DataFrame, kind: str, dedup: bool = True) -> DataFrame:
    """Typed analog readings of one device type."""
    typed = typed_readings(raw, kind)
    rows = _newest_arrival(typed) if dedup else typed.filter(F.col("timestamp").isNotNull())
    return rows.select(*analog_columns(kind))


def discrete_codes(payload: Column, rule: DiscreteRule) -> Column:
    """The part of a parsed payload that holds discrete codes; NULL when there is none."""

    def kept(key: Column, _value: Column) -> Column:
        wanted = ~key.isin(*rule.excluded)
        if rule.codes_only:
            wanted = wanted & (key.rlike(r"^[0-9]+\z") | key.isin(*rule.named))
        return wanted

    codes = F.map_filter(payload, kept)
    return F.when(F.size(codes) > 0, codes)


def stage_discrete(raw: DataFrame, kind: str, rule: DiscreteRule | None = None) -> DataFrame:
    """Discrete codes of one device type as a JSON object; new codes need no new columns.

    Values keep their JSON types: ``true`` stays a boolean, ``0`` a number and ``"1@x"`` a string. Numbers are
    written without zeros at the end of a fraction (`1.50` is `1.5`, `188.0` is `188`).
    """
    rule = rule or DISCRETE_RULES[kind]
    parsed = raw.select(
        *_arrival_columns(), "power_plant_id", "device_id", payload_typed(F.col("json_data")).alias("p")
    )
    codes = parsed.select(
        _ARRIVED,
        _TIE,
        payload_local(typed_text(F.col("p")["timestamp"])).alias("timestamp"),
        "power_plant_id",
        "device_id",
        F.to_json(discrete_codes(F.col("p"), rule)).alias("discrete_data_json"),
    )
    # The newest arrival is chosen first: when it holds no code, older copies do not come back.
    return _newest_arrival(codes).filter(F.col("discrete_data_json").isNotNull()).select(*IDS, "discrete_data_json")


def unreadable_readings(raw: DataFrame) -> DataFrame:
    """Raw rows that staging leaves out because their payload carries no readable time."""
    parsed = payload_struct(F.col("json_data"), ["timestamp"])
    return raw.filter(payload_local(parsed["timestamp"]).isNull())


def newest_records(raw: DataFrame, valid_from: str) -> DataFrame:
    """Newest raw record of each device from the given time on whose payload names a time, unparsed otherwise."""
    recent = between(raw, naive_timestamp(valid_from).cast("timestamp"), closed_lower=True)
    present = recent.filter(payload_struct(F.col("json_data"), ["timestamp"])["timestamp"].isNotNull())
    return newest_per(
        present.select("timestamp", "power_plant_id", "device_id", "json_data"),
        ["device_id"],
        [F.desc("timestamp"), F.desc(F.xxhash64("json_data"))],
    )


def latest_string_currents(
    raw: DataFrame, devices: DataFrame, valid_from: str, strings: int = STRINGS_PER_INVERTER
) -> DataFrame:
    """Newest record of each inverter, one row per string that reports a current."""
    names = [f"string_{n}_current" for n in range(1, strings + 1)]
    # Only the one winner per device is parsed in full.
    parsed = newest_records(raw, valid_from).select(
        "power_plant_id",
        "device_id",
        payload_struct(F.col("json_data"), ["timestamp", "state_simplified", *names]).alias("p"),
    )
    currents = F.expr("array(" + ", ".join(grid_value_sql(f"p.{name}", DECIMAL2) for name in names) + ")")
    strung = parsed.select(
        payload_local(F.col("p.timestamp")).alias("timestamp"),
        "power_plant_id",
        "device_id",
        grid_value("p.state_simplified", INTEGER).alias("state_simplified"),
        F.posexplode(currents).alias("position", "string_current"),
    ).filter(F.col("string_current").isNotNull())
    labels = devices.select(F.col("id").alias("device_id"), "device_name")
    return strung.join(labels, "device_id", "left").select(
        "timestamp",
        "power_plant_id",
        "device_id",
        "device_name",
        (F.col("position") + 1).alias("string_number"),
        "string_current",
        "state_simplified",
    )
