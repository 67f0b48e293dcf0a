"""Streams with keyed state: newest copy per reading, changes of state, and silent devices.

State lies in RocksDB, one small entry per key, and event-time timers end the waiting, so results come without a row
arriving. A reading counts once the watermark has passed it; up to then copies and readings may come in any order.
Readings later than the watermark's delay are left to the batch run, which reads them from the stored table.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from helioframe.functions.clock import LOCAL_OFFSET_HOURS, interval, payload_instant, payload_local
from helioframe.functions.gridvalue import payload_typed, typed_text
from helioframe.operators.events import explode_codes
from helioframe.operators.staging import discrete_codes, typed_readings
from helioframe.specs import DEVICE_TYPES, DISCRETE_RULES, IDS, analog_columns
from helioframe.streaming.readings import EVENT_TIME, _instant

_HOUR = 3_600_000_000
#: Event time as the functions see it: microseconds, which no time zone can shift.
_AT = "__at"


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _timer(at: int) -> int:
    """The first whole millisecond, as timers count, that is not before a moment."""
    return -(-at // 1000)


def _newest_copy(rows: DataFrame, columns: list[str], arrived: list[str | Column], delay: str) -> DataFrame:
    """One row per device and event time: of copies inside the watermark the newest arrival. For append mode.

    The copy is chosen by an aggregate, so each task sends one row a reading to the shuffle.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*arrived))
    grouped = rows.withWatermark(EVENT_TIME, delay).groupBy("device_id", EVENT_TIME).agg(newest.alias("r"))
    return grouped.select(EVENT_TIME, *(F.col(f"r.{name}").alias(name) for name in columns))


def stream_staged(raw: DataFrame, kind: str, delay: str = "1 hour") -> DataFrame:
    """Typed readings as ``stage_analog`` gives them, with the instant of each as ``event_time``."""
    typed = typed_readings(raw, kind).filter(F.col("timestamp").isNotNull())
    timed = typed.withColumn(EVENT_TIME, _instant(F.col("timestamp")))
    return _newest_copy(timed, analog_columns(kind), ["__arrived_at", "__payload_hash"], delay)


def stream_discrete(raw: DataFrame, kind: str, delay: str = "1 hour") -> DataFrame:
    """Discrete codes as ``stage_discrete`` gives them; a newest copy without codes leaves no row."""
    parsed = raw.select(
        F.col("timestamp").alias("__arrived_at"),
        F.xxhash64("json_data").alias("__payload_hash"),
        "power_plant_id",
        "device_id",
        payload_typed(F.col("json_data")).alias("p"),
    )
    text = F.to_json(discrete_codes(F.col("p"), DISCRETE_RULES[kind]))
    timed = parsed.select(
        "*",
        payload_instant(typed_text(F.col("p")["timestamp"])).alias(EVENT_TIME),
        payload_local(typed_text(F.col("p")["timestamp"])).alias("timestamp"),
        text.alias("discrete_data_json"),
    ).filter(F.col(EVENT_TIME).isNotNull())
    rows = _newest_copy(timed, [*IDS, "discrete_data_json"], ["__arrived_at", "__payload_hash"], delay)
    return rows.filter(F.col("discrete_data_json").isNotNull())


CHANGE = T.StructType(
    [
        T.StructField(_AT, T.LongType()),
        T.StructField("power_plant_id", T.LongType()),
        T.StructField("device_id", T.LongType()),
        T.StructField("device_type_id", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("value", T.IntegerType()),
    ]
)


class _Changes(StatefulProcessor):
    """Of one device and code: the last value, and the readings the watermark has not passed yet.

    Readings wait for a timer at the end of their hour, are then put in order, and only the changes leave.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "value int")
        self.waiting = handle.getMapState("waiting", "at long", "power_plant_id long, device_type_id int, value int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due = set()
        for row in rows:
            self.waiting.updateValue((row[_AT],), (row["power_plant_id"], row["device_type_id"], row["value"]))
            due.add(row[_AT] // _HOUR * _HOUR + _HOUR)
        for moment in due:
            self.handle.registerTimer(_timer(moment))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        ready = sorted((at[0], *reading) for at, reading in self.waiting.iterator() if at[0] < end)
        last = self.last.get()
        last = None if last is None else last[0]
        for at, plant, kind, value in ready:
            self.waiting.removeKey((at,))
            if value != last:
                last = value
                yield Row(**{_AT: at}, power_plant_id=plant, device_id=key[0], device_type_id=kind, code=key[1], value=value)
        if ready:
            self.last.update((last,))

    def close(self) -> None:
        pass


def stream_state_changes(discrete: DataFrame, kind: str) -> DataFrame:
    """Changes of state from a stream of ``stream_discrete``, as ``state_changes`` finds them in the stored table.

    A code's readings of an hour come out once the watermark has passed the hour. ``timestamp`` is plant-local.
    """
    tagged = discrete.withColumn("device_type_id", F.lit(DEVICE_TYPES[kind]))
    readings = explode_codes(tagged).select(
        EVENT_TIME, F.unix_micros(EVENT_TIME).alias(_AT), F.col("device_id").cast("long"), "code", F.col("power_plant_id").cast("long"), "device_type_id", "value"
    )
    changes = readings.groupBy("device_id", "code").transformWithState(
        statefulProcessor=_Changes(), outputStructType=CHANGE, outputMode="Append", timeMode="EventTime"
    )
    local = (F.timestamp_micros(_AT) - interval(f"{LOCAL_OFFSET_HOURS} hours")).cast("timestamp_ntz")
    return changes.select(local.alias("timestamp"), *CHANGE.names[1:])


TRANSITION = T.StructType(
    [
        T.StructField("device_id", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField(_AT, T.LongType()),
    ]
)


class _Silence(StatefulProcessor):
    """Of one device: its newest reading and class. Timers tell when it turns stale, and when it counts as absent."""

    def __init__(self, stale_after: timedelta, absent_after: timedelta):
        self.limits = {"stale": _micros(stale_after), "absent": _micros(absent_after)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "newest long, state string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest, held = max(row[_AT] for row in rows), self.held.get()
        if held is not None and held[0] >= newest:
            return
        for moment in list(self.handle.listTimers()):
            self.handle.deleteTimer(moment)
        for limit in self.limits.values():
            self.handle.registerTimer(_timer(newest + limit))
        if held is None or held[1] != "fresh":
            yield Row(device_id=key[0], state="fresh", **{_AT: newest})
        self.held.update((newest, "fresh"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest, state = self.held.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        turned = "absent" if at >= _timer(newest + self.limits["absent"]) else "stale"
        if turned != state:
            self.held.update((newest, turned))
            yield Row(device_id=key[0], state=turned, **{_AT: newest + self.limits[turned]})

    def close(self) -> None:
        pass


def stream_staleness(raw: DataFrame, stale_after: timedelta, absent_after: timedelta, delay: str = "1 minute") -> DataFrame:
    """device_id, state (fresh, stale or absent) and the instant since when, one row for each transition of a device.

    Any device's readings move the watermark, so a silent device turns stale and absent without a row of its own.
    """
    payload = F.from_json("json_data", "struct<timestamp:string>")
    timed = raw.select(F.col("device_id").cast("long"), payload_instant(payload["timestamp"]).alias(EVENT_TIME))
    timed = timed.filter(F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, delay).withColumn(_AT, F.unix_micros(EVENT_TIME))
    turns = timed.groupBy("device_id").transformWithState(
        statefulProcessor=_Silence(stale_after, absent_after), outputStructType=TRANSITION, outputMode="Append", timeMode="EventTime"
    )
    return turns.select("device_id", "state", F.timestamp_micros(_AT).alias("since"))
