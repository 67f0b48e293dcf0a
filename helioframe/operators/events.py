"""Change-of-state detection on discrete codes, and its enrichment into events and alarms."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioframe.functions.clock import between, naive_timestamp
from helioframe.functions.gridvalue import payload_map
from helioframe.functions.text import event_id
from helioframe.operators.dedup import newest_per
from helioframe.specs import BINARY_TEXTS, DEVICE_TYPES

_SPAN = "__span"
_LANE = "__lane"
_FIRST = "__first_in_span"
_SPAN_LAST = "__span_last"
_SEED = "__seed"
_STATE_KEY = ["device_id", "code"]


def discrete_union(discrete_by_kind: Mapping[str, DataFrame], valid_from: str | None = None) -> DataFrame:
    """Discrete readings of several device types in one frame, tagged with the type."""

    def tagged(kind: str, df: DataFrame) -> DataFrame:
        if valid_from is not None:
            df = between(df, naive_timestamp(valid_from), closed_lower=True)
        return df.select(
            "timestamp",
            "power_plant_id",
            "device_id",
            F.lit(DEVICE_TYPES[kind]).alias("device_type_id"),
            "discrete_data_json",
        )

    return reduce(DataFrame.unionByName, (tagged(kind, df) for kind, df in discrete_by_kind.items()))


def explode_codes(discrete: DataFrame) -> DataFrame:
    """One row per code that carries an on/off text; all other texts are left out."""
    pairs = discrete.select(
        *(c for c in discrete.columns if c != "discrete_data_json"),
        F.explode(payload_map(F.col("discrete_data_json"))).alias("code", "text"),
    )
    on = [text for text, state in BINARY_TEXTS.items() if state == 1]
    return (
        pairs.filter(F.col("text").isin(*BINARY_TEXTS))
        .withColumn("value", F.col("text").isin(*on).cast("int"))
        .drop("text")
    )


def rejected_codes(discrete: DataFrame) -> DataFrame:
    """How many readings per code were left out because their text is no on/off state."""
    pairs = discrete.select(F.explode(payload_map(F.col("discrete_data_json"))).alias("code", "text"))
    return (
        pairs.filter(F.col("text").isNull() | ~F.col("text").isin(*BINARY_TEXTS))
        .groupBy("code")
        .agg(F.count("*").alias("rejected"))
    )


def last_known_states(events: DataFrame) -> DataFrame:
    """Newest stored value of each device and code."""
    newest = newest_per(events.select(*_STATE_KEY, "timestamp", "value"), _STATE_KEY, [F.desc("timestamp"), F.desc("value")])
    return newest.select(*_STATE_KEY, F.col("value").alias("last_value"))


def states_before(discrete: DataFrame, moment: Column) -> DataFrame:
    """Value of each device and code in its newest reading up to the moment.

    An aggregate with partial maxima in every task, so of a long history one row per code is shuffled.
    """
    readings = explode_codes(discrete.filter(F.col("timestamp") <= moment))
    newest = F.max_by("value", F.struct("timestamp", "value")).alias("last_value")
    return readings.groupBy(*_STATE_KEY).agg(newest)


def state_changes_after(discrete: DataFrame, moment: Column) -> DataFrame:
    """The changes of state after the moment: those of ``state_changes`` without comparing the history before it."""
    return state_changes(between(discrete, moment), states_before(discrete, moment))


def state_changes(discrete: DataFrame, last_states: DataFrame | None = None) -> DataFrame:
    """Rows where a code takes another value than before, first occurrences included.

    A single window per device and code would put the whole history of one busy code into one task.
    So the work is done per hour first: readings are shuffled once, unexploded, by device and hour,
    compared with the reading before them inside the hour, and only the hour's changes and its first
    reading go on. The first readings of the hours, each with the last value of its hour, are then
    compared along the hours; known states take part as a reading older than all others. One task
    sees at most one hour of one device, or one row per hour of one code.
    """
    spans = discrete.withColumn(_SPAN, F.date_trunc("hour", "timestamp")).repartition("device_id", _SPAN)
    readings = explode_codes(spans)

    in_span = Window.partitionBy("device_id", _SPAN, "code").orderBy("timestamp", "value")
    whole_span = in_span.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = readings.withColumns(
        {
            "__before": F.lag("value").over(in_span),
            _SPAN_LAST: F.last("value").over(whole_span),
        }
    )
    starts = compared.filter(F.col("__before").isNull() | (F.col("__before") != F.col("value"))).select(
        "timestamp",
        "power_plant_id",
        "device_id",
        "device_type_id",
        "code",
        "value",
        F.col("__before").isNull().alias(_FIRST),
        F.lit(False).alias(_SEED),
        _SPAN_LAST,
        F.when(F.col("__before").isNotNull(), F.col(_SPAN)).alias(_LANE),
    )
    if last_states is not None:
        known = last_states.select(
            "device_id",
            "code",
            F.lit(True).alias(_FIRST),
            F.lit(True).alias(_SEED),
            F.col("last_value").cast("int").alias(_SPAN_LAST),
        )
        starts = starts.unionByName(known, allowMissingColumns=True)

    # Changes inside an hour are settled and spread by their hour; first readings share the NULL lane.
    along_spans = Window.partitionBy(*_STATE_KEY, _LANE).orderBy(F.col("timestamp").asc_nulls_first())
    previous = F.lag(_SPAN_LAST).over(along_spans)
    settled = starts.withColumn("__previous", F.when(F.col(_FIRST), previous))
    changed = ~F.col(_FIRST) | F.col("__previous").isNull() | (F.col("__previous") != F.col("value"))
    return settled.filter(~F.col(_SEED) & changed).select(
        "timestamp", "power_plant_id", "device_id", "device_type_id", "code", "value"
    )


def enrich_events(changes: DataFrame, catalog: DataFrame, devices: DataFrame, plants: DataFrame) -> DataFrame:
    """Changes with catalog texts, names and an id; a code the catalog lacks becomes a high alarm.

    The dimensions carry no broadcast hint: Spark broadcasts each one only while its measured size is
    below the threshold, and joins by sort-merge with skew splitting beyond that.
    """
    known = catalog.filter("is_active").select("code", "value", "device_type_id", "description", "type", "severity")
    device_names = devices.select(F.col("id").alias("device_id"), "device_name")
    plant_names = plants.select(F.col("id").alias("power_plant_id"), F.col("name").alias("power_plant_name"))
    enriched = (
        changes.join(known, ["code", "value", "device_type_id"], "left")
        .join(device_names, "device_id", "left")
        .join(plant_names, "power_plant_id", "left")
    )
    unknown = F.concat(
        F.lit('Código "'),
        F.col("code"),
        F.lit('" não cadastrado (device_type_id='),
        F.col("device_type_id").cast("string"),
        F.lit(", value="),
        F.col("value").cast("string"),
        F.lit(")"),
    )
    return enriched.select(
        event_id(F.col("device_id"), F.col("timestamp"), F.col("code")).alias("id"),
        "timestamp",
        "power_plant_id",
        "power_plant_name",
        "device_id",
        "device_name",
        "device_type_id",
        "code",
        "value",
        F.coalesce("description", unknown).alias("description"),
        F.coalesce("type", F.lit("alarm")).alias("type"),
        F.coalesce("severity", F.lit("high")).alias("severity"),
        F.lit(False).alias("acknowledged"),
        F.lit(None).cast("string").alias("acknowledged_by"),
        F.lit(None).cast("timestamp_ntz").alias("acknowledged_at"),
    )


def detect_state_changes(
    discrete_by_kind: Mapping[str, DataFrame],
    catalog: DataFrame,
    devices: DataFrame,
    plants: DataFrame,
    last_states: DataFrame | None = None,
    valid_from: str | None = None,
) -> DataFrame:
    """Events and alarms from the discrete readings of several device types."""
    changes = state_changes(discrete_union(discrete_by_kind, valid_from), last_states)
    return enrich_events(changes, catalog, devices, plants)


def with_acknowledgements(events: DataFrame, acknowledgements: DataFrame) -> DataFrame:
    """Events marked by operators; takes rows of (id, acknowledged_by, acknowledged_at)."""
    marks = acknowledgements.select("id", F.col("acknowledged_by").alias("__by"), F.col("acknowledged_at").alias("__at"))
    marks = newest_per(marks, ["id"], [F.desc("__at"), F.asc("__by")])
    joined = events.join(marks, "id", "left")
    return joined.withColumns(
        {
            "acknowledged": F.col("acknowledged") | F.col("__at").isNotNull(),
            "acknowledged_by": F.coalesce("__by", "acknowledged_by"),
            "acknowledged_at": F.coalesce("__at", "acknowledged_at"),
        }
    ).select(*events.columns)
