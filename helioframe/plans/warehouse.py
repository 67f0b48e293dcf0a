"""The stored warehouse: raw to staged to intermediate tables to the plant overview.

``run`` does a full refresh or an incremental run; a stream feeds the same steps one micro-batch at a
time. Both give the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.clock import DAY, Clock, LiveClock, between, interval, naive_timestamp
from helioframe.operators.availability import availability
from helioframe.operators.dedup import newest_per
from helioframe.operators.energy import daily_energy, energy_window, plant_daily_energy
from helioframe.operators.events import discrete_union, enrich_events, state_changes, with_acknowledgements
from helioframe.operators.incremental import incremental_filter, watermark_of, within_horizon
from helioframe.operators.latest import latest_readings, latest_readings_long, merge_latest
from helioframe.operators.quality import declared_checks
from helioframe.operators.staging import latest_string_currents, newest_records, stage_analog, stage_discrete
from helioframe.operators.status import plant_status
from helioframe.plans.overview import plants_overview
from helioframe.schemas import RAW
from helioframe.session import ensure_utc
from helioframe.sources import sinks
from helioframe.sources.control import Positions
from helioframe.sources.files import child_folders
from helioframe.sources.tables import read_table, table_exists
from helioframe.sources.versioned import Table, day_of
from helioframe.specs import (
    ANALOG_FIELDS,
    COMMUNICATION_WINDOW,
    DECLARED_CHECKS,
    DISCRETE_RULES,
    READING_LOOKBACK,
    RETENTION,
    STALE_AFTER,
    TABLE_KEYS,
    VALID_FROM,
    WEATHER_HORIZON,
)

STRING_RECORDS = "int_inverter_newest_records"
READING_KEY = ("device_id", "timestamp")
STATE_KEY = ("device_id", "code")
EVENT_KINDS = ("inverter", "relay")
_NONE_LATE = datetime(9999, 1, 1)
STATUS_KINDS = ("inverter", "logger", "meter", "relay", "weather_station")
HISTORY_LATEST = ("meter", "relay", "tracker", "weather_station")


def _newest_event() -> list[Column]:
    return [F.desc("timestamp"), F.desc("id")]


@dataclass(frozen=True)
class Inputs:
    """Raw telemetry per device type, and the reference tables."""

    raw: Mapping[str, DataFrame]
    devices: DataFrame
    plants: DataFrame
    catalog: DataFrame
    # Marks of the operators: id of an event, acknowledged_by, acknowledged_at.
    acknowledgements: DataFrame | None = None


@dataclass(frozen=True)
class Limits:
    """Time limits of a deployment."""

    valid_from: str = VALID_FROM
    lookback: str = READING_LOOKBACK
    stale_after: str = STALE_AFTER
    window: str = COMMUNICATION_WINDOW
    weather_horizon: str = WEATHER_HORIZON
    retention: str = RETENTION
    # Events of this long before the newest reading are worked out again, so readings that come late
    # by no more than this still change them.
    allowed_lateness: str = "1 hour"
    # Folders that the rows of a day are dealt into by the hash of their key: a changed row has one of them written
    # anew. A fitting number is the size of a day over a quarter of a gigabyte.
    buckets: int = 2
    # Seconds for which files that were replaced stay, for readers that still run.
    keep_replaced: float = 86400.0


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    inputs: Inputs
    limits: Limits = field(default_factory=Limits)

    def __post_init__(self) -> None:
        ensure_utc(self.spark)
        self.positions = Positions(self.spark, self.path("_positions"))
        self._reached: dict[str, datetime] = {}
        self._views: Clock | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def stored(self, name: str, key: Sequence[str] = (), partition: str | None = DAY) -> Table:
        """The table to write to; every write of it is published in one step."""
        return Table(self.spark, self.path(name), partition, key, self.limits.buckets)

    def has(self, name: str) -> bool:
        return table_exists(self.spark, self.path(name))

    def staged(self, kind: str, family: str = "analogic") -> DataFrame:
        """A staged table; without rows while no reading of the device type has come in."""
        name = f"stg_{kind}_{family}_data"
        if self.has(name):
            return self.table(name)
        nothing = self.spark.createDataFrame([], RAW)
        return sinks.with_day(stage_analog(nothing, kind) if family == "analogic" else stage_discrete(nothing, kind))

    def latest(self, kind: str) -> DataFrame:
        name = f"int_{kind}_latest_readings"
        return self.table(name) if self.has(name) else latest_readings(self.staged(kind), kind)

    def events(self) -> DataFrame:
        if self.has("int_events_alarms"):
            return self.table("int_events_alarms")
        nothing = discrete_union({kind: self.staged(kind, "discrete").limit(0) for kind in EVENT_KINDS})
        dimensions = (self.inputs.catalog, self.inputs.devices, self.inputs.plants)
        return sinks.with_day(enrich_events(state_changes(nothing), *dimensions))

    # Staging

    def absorb(self, kind: str, raw: DataFrame, clock: Clock, full: bool = False) -> list[date]:
        """Stage a batch of raw rows of one device type and put it into the stored tables.

        Returns the local days its analog readings belong to.
        """
        if kind == "weather_station":
            raw = within_horizon(raw, clock, self.limits.weather_horizon)
        analog = sinks.with_day(stage_analog(raw, kind))
        days = self._store(f"stg_{kind}_analogic_data", analog, full)
        if kind in DISCRETE_RULES:
            noted = self._note_late if kind in EVENT_KINDS else None
            self._store(f"stg_{kind}_discrete_data", sinks.with_day(stage_discrete(raw, kind)), full, noted)
        if kind in HISTORY_LATEST:
            self._refresh_latest(kind, raw, full)
        if kind == "inverter":
            self._refresh_records(raw, full)
        return days

    def _store(
        self, name: str, rows: DataFrame, full: bool, on_change: Callable[[DataFrame], None] | None = None
    ) -> list[date]:
        table = self.stored(name, READING_KEY)
        if not full:
            return table.upsert(rows, READING_KEY, on_change=on_change)
        table.create(rows)
        return []

    def _note_late(self, changed: DataFrame) -> None:
        """Record, before they are stored, how far back new discrete readings go behind the settled time.

        It is kept with the positions, so a run that dies after storing them still brings their events up.
        """
        settled = self.positions.read("settled_events")
        oldest = None if settled is None else changed.agg(F.min("timestamp")).first()[0]
        if oldest is None or oldest > settled:
            return
        noted = self.positions.read("late_events")
        if noted is None or oldest < noted:
            self.positions.write("late_events", oldest)

    def _refresh_latest(self, kind: str, raw: DataFrame, full: bool) -> None:
        name = f"int_{kind}_latest_readings"
        if full or not self.has(name):
            newest = latest_readings(self.staged(kind), kind)
        else:
            newest = merge_latest(self.table(name), latest_readings(stage_analog(raw, kind), kind))
        self.stored(name, partition=None).create(newest)

    def _refresh_records(self, raw: DataFrame, full: bool) -> None:
        """Newest raw record of each inverter, merged load by load, so string currents never look through all records."""
        newest = newest_records(raw, self.limits.valid_from)
        if not full and self.has(STRING_RECORDS):
            newest = newest_records(self.table(STRING_RECORDS).unionByName(newest), self.limits.valid_from)
        elif not full and self.positions.read("raw_inverter") is not None:
            # The warehouse is older than this table: what it has loaded before counts too.
            newest = newest_records(self.inputs.raw["inverter"], self.limits.valid_from)
        self.stored(STRING_RECORDS, partition=None).create(newest)

    def load(self, kind: str, clock: Clock, full: bool = False) -> list[date]:
        """Stage the raw rows that arrived since the last load, up to the clock.

        Rows up to ``allowed_lateness`` before that are read again, because a row may be written after newer
        ones; the stored table takes the same row only once.
        The new position is only recorded by ``commit``, after the derived tables have been brought up
        too: a run that dies half-way is simply repeated, and repeating it changes nothing.
        """
        name = f"raw_{kind}"
        arrived = self.inputs.raw[kind].filter(F.col("timestamp") <= clock.instant())
        done = None if full else self.positions.read(name)
        batch = incremental_filter(arrived, done, allowed_lateness=self.limits.allowed_lateness)
        newest = watermark_of(batch)
        if newest is None:
            return []
        days = self.absorb(kind, batch, clock, full)
        self._reached[name] = newest if done is None else max(newest, done)
        return days

    def commit(self) -> None:
        for name, position in self._reached.items():
            self.positions.write(name, position)
        self._reached.clear()
        noted = self.positions.read("late_events")
        if noted is not None and noted < _NONE_LATE:
            self.positions.write("late_events", _NONE_LATE)

    # Events

    def refresh_events(self, clock: Clock, full: bool = False) -> None:
        """Events after the settled time, or since the oldest late reading, are worked out again.

        A reading whose own time lies beyond the clock waits in the staged table until that time has come, so
        a device with a wrong clock holds up no other.
        The newest event of each plant, device and code up to the settled time is kept in a table of its
        own, so neither this run nor the overview looks through old events for it.
        """
        settled = None if full else self.positions.read("settled_events")
        readings = {
            kind: self.table(f"stg_{kind}_discrete_data")
            for kind in EVENT_KINDS
            if self.has(f"stg_{kind}_discrete_data")
        }
        if not readings:
            return
        since = settled
        if settled is not None:
            late = self.positions.read("late_events")
            if late is not None and late <= settled:
                since = late - timedelta(microseconds=1)
            readings = {kind: between(df, naive_timestamp(since)) for kind, df in readings.items()}
        due = {kind: df.filter(F.col("timestamp") <= clock.local()) for kind, df in readings.items()}
        discrete = discrete_union(due, self.limits.valid_from)
        newest = watermark_of(discrete)
        if newest is None:
            return
        known = self._states(settled)
        if since != settled:
            older = self.events().filter(F.col("timestamp") <= naive_timestamp(since)).drop(DAY)
            # Written out, because the files it comes from are replaced below.
            known = sinks.materialize(self.spark, newest_per(older, ["power_plant_id", *STATE_KEY], _newest_event()))
        seeds = None
        if known is not None:
            newest_known = newest_per(known, STATE_KEY, _newest_event())
            seeds = newest_known.select(*STATE_KEY, F.col("value").alias("last_value"))
        dimensions = (self.inputs.catalog, self.inputs.devices, self.inputs.plants)
        changes = state_changes(discrete, seeds)
        fresh = sinks.materialize(self.spark, sinks.with_day(enrich_events(changes, *dimensions)))
        self._replace_events(fresh, since)

        settle = self._earlier(newest)
        if settled is not None:
            settle = max(settle, settled)
        if settle != settled or since != settled:
            states = fresh.filter(F.col("timestamp") <= naive_timestamp(settle)).drop(DAY)
            if known is not None:
                states = states.unionByName(known, allowMissingColumns=True)
            kept = newest_per(states, ["power_plant_id", *STATE_KEY], _newest_event())
            Table(self.spark, self._states_path(settle), None).create(kept)
            self.positions.write("settled_events", settle)
            if settled is not None and settle != settled:
                sinks.delete_path(self.spark, self._states_path(settled))
        sinks.discard(self.spark, fresh)
        if since != settled:
            sinks.discard(self.spark, known)

    def current_events(self) -> DataFrame:
        """Enough events to tell every current alarm state: the kept ones and those after them, with their marks."""
        settled = self.positions.read("settled_events")
        if settled is None:
            return self.marked(self.events().drop(DAY))
        recent = between(self.events(), naive_timestamp(settled)).drop(DAY)
        return self.marked(self._states(settled).unionByName(recent, allowMissingColumns=True))

    def marked(self, events: DataFrame) -> DataFrame:
        """Events with what operators have acknowledged by now; marks are joined when read, so stored events stay as they are."""
        marks = self.inputs.acknowledgements
        return events if marks is None else with_acknowledgements(events, marks)

    def _earlier(self, moment: datetime) -> datetime:
        bound = naive_timestamp(moment) - interval(self.limits.allowed_lateness)
        return self.spark.range(1).select(bound.alias("t")).first()["t"]

    def _states_path(self, settled: datetime) -> str:
        return self.path(f"_event_states/{settled.strftime('%Y%m%dT%H%M%S%f')}")

    def _states(self, settled: datetime | None) -> DataFrame | None:
        return None if settled is None else read_table(self.spark, self._states_path(settled))

    def _replace_events(self, fresh: DataFrame, settled: datetime | None) -> None:
        table = self.stored("int_events_alarms", ["id"])
        if settled is None:
            table.create(fresh)
            return
        # A new or removed column is taken over without touching stored rows.
        table.evolve(fresh.schema)
        first_day = settled.date()
        kept = table.read().filter((F.col(DAY) == F.lit(first_day)) & (F.col("timestamp") <= naive_timestamp(settled)))
        table.replace(kept.unionByName(fresh), gone=lambda value: (day_of(value) or first_day) >= first_day)

    # Intermediate tables and the overview

    def refresh_energy(self, clock: Clock, full: bool = False, days: Sequence[date] = ()) -> None:
        """Days of the recompute window, and any older day that late readings belong to."""
        analog = self.staged("inverter")
        for name, compute, keys in (
            ("int_inverter_daily_energy_timeseries", daily_energy, ["date"]),
            ("int_inverter_power_plant_daily_energy_timeseries", plant_daily_energy, ["date", "power_plant_id"]),
        ):
            if full or not self.has(name):
                self.stored(name).create(compute(analog))
            else:
                self.stored(name).upsert(compute(energy_window(analog, clock, also=days)), keys)

    def refresh_availability(self, clock: Clock) -> None:
        for kind, staged in (("inverter", "analogic"), ("relay", "discrete"), ("tracker", "discrete")):
            share = availability(
                self.inputs.devices,
                self.inputs.plants,
                self.staged(kind, staged),
                kind,
                clock,
                lookback=self.limits.lookback,
                stale_after=self.limits.stale_after,
            )
            self.stored(f"int_{kind}_availability", partition=None).create(share)

    def refresh_logger_latest(self, clock: Clock) -> None:
        newest = latest_readings(self.staged("logger"), "logger", clock, self.limits.lookback)
        self.stored("int_logger_latest_readings", partition=None).create(newest)

    def inverter_latest(self, clock: Clock) -> DataFrame:
        return latest_readings_long(self.staged("inverter"), clock, self.limits.lookback)

    def status(self, clock: Clock) -> DataFrame:
        readings = {kind: self.staged(kind) for kind in STATUS_KINDS}
        return plant_status(readings, self.events(), self.inputs.plants, clock, self.limits.window)

    def string_currents(self) -> DataFrame:
        """String currents of the newest loaded record of each inverter."""
        records = self.table(STRING_RECORDS) if self.has(STRING_RECORDS) else self.inputs.raw["inverter"]
        return latest_string_currents(records, self.inputs.devices, self.limits.valid_from)

    def overview(self, clock: Clock) -> DataFrame:
        return plants_overview(
            self.inputs.plants,
            self.latest("weather_station"),
            self.table("int_inverter_availability"),
            self.table("int_relay_availability"),
            self.current_events(),
            self.inverter_latest(clock),
            self.staged("inverter"),
            self.staged("weather_station"),
            clock,
            lookback=self.limits.lookback,
            window=self.limits.window,
        )

    def refresh_derived(self, clock: Clock, full: bool = False, days: Sequence[date] = ()) -> None:
        self.refresh_events(clock, full)
        self.refresh_energy(clock, full, days)
        self.refresh_availability(clock)
        self.refresh_logger_latest(clock)
        self.stored("mart_power_plants_overview", partition=None).create(self.overview(clock))

    def register_views(self, clock: Clock | None = None) -> None:
        """The tables that are always computed when read, at the reader's own time unless a clock is given.

        A view reads the table versions of its registration; every later ``run`` of this warehouse registers it anew.
        """
        self._views = clock = clock or LiveClock()
        sinks.create_view(self.inverter_latest(clock), "int_inverter_latest_readings")
        sinks.create_view(self.status(clock), "int_power_plant_status")
        sinks.create_view(self.string_currents(), "stg_inverter_string_data")
        sinks.create_view(self.marked(self.events()), "int_events_alarms_acknowledged")

    def run(self, clock: Clock, full: bool = False) -> None:
        """Bring every stored table up to the clock."""
        loaded = {kind: self.load(kind, clock, full) for kind in self.inputs.raw}
        self.refresh_derived(clock, full, loaded.get("inverter", []))
        self.commit()
        if self._views is not None:
            self.register_views(self._views)

    def checks(self, clock: Clock) -> DataFrame:
        """The declared checks over every stored table, the views and the inputs."""
        tables = {f"raw_{kind}": raw for kind, raw in self.inputs.raw.items()}
        tables |= {
            "tb_power_plants": self.inputs.plants,
            "tb_devices": self.inputs.devices,
            "tb_event_alarm_catalog": self.inputs.catalog,
            "int_inverter_latest_readings": self.inverter_latest(clock),
            "int_power_plant_status": self.status(clock),
            "stg_inverter_string_data": self.string_currents(),
        }
        stored = (set(DECLARED_CHECKS) | set(TABLE_KEYS)) - set(tables)
        tables |= {name: self.table(name) for name in sorted(stored) if self.has(name)}
        return declared_checks(tables)

    def maintain(self, clock: Clock, compact_days: int = 1) -> None:
        """Daily upkeep: cluster the days that have settled and drop those past retention."""
        staged = [f"stg_{kind}_analogic_data" for kind in ANALOG_FIELDS]
        staged += [f"stg_{kind}_discrete_data" for kind in DISCRETE_RULES]
        for name in staged:
            if self.has(name):
                sinks.drop_expired(self.spark, self.path(name), clock, self.limits.retention)
                sinks.compact(self.spark, self.path(name), clock, days=compact_days)
        self.positions.compact()
        for name in child_folders(self.spark, self.root):
            if Table.is_at(self.spark, self.path(name)):
                Table(self.spark, self.path(name)).vacuum(self.limits.keep_replaced)

