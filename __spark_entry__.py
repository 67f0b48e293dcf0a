"""Registered queries over the test tables, and the SQL each one is checked against."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helioframe.functions.clock import Clock  # noqa: E402
from helioframe.functions.gridvalue import grid_value, payload_struct  # noqa: E402
from helioframe.functions.sqlfunctions import register  # noqa: E402
from helioframe.operators import adhoc, energy, events, incremental, latest, performance, quality, staging, status  # noqa: E402
from helioframe.operators.availability import availability, device_staleness  # noqa: E402
from helioframe.plans.overview import plants_overview  # noqa: E402
from helioframe.session import shared_dir  # noqa: E402
from helioframe.sources import sinks  # noqa: E402
from helioframe.sources import testdata as td  # noqa: E402
from helioframe.sources.files import temporary  # noqa: E402
from helioframe.sources.versioned import Table  # noqa: E402
from helioframe.specs import WEATHER_HORIZON  # noqa: E402
from helioframe.sources.testdata import Telemetry  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
_WIDE = {
    "inverter": "inverter",
    "relay": "relay",
    "logger": "logger",
    "meter": "meter",
    "weather": "weather_station",
    "tracker": "tracker",
}
_REPORTED = ["timestamp", "power_plant_id", "device_id", "active_power", "frequency", "power_factor", "state_operation"]


class Models:
    """The reference tables and models over one test folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.data = Telemetry(spark, folder)

    @cached_property
    def clock(self) -> Clock:
        return self.data.clock()

    @cached_property
    def devices(self) -> DataFrame:
        return self.data.devices()

    @cached_property
    def plants(self) -> DataFrame:
        return self.data.plants()

    @cached_property
    def catalog(self) -> DataFrame:
        return self.data.catalog()

    def raw(self, kind: str) -> DataFrame:
        return self.data.raw(kind)

    def analog(self, kind: str) -> DataFrame:
        raw = self.raw(kind)
        if kind == "weather_station":
            raw = incremental.within_horizon(raw, self.clock, WEATHER_HORIZON)
        return staging.stage_analog(raw, kind)

    def analog_corrected(self, kind: str) -> DataFrame:
        return staging.stage_analog(incremental.month_to_date(self.raw(kind), self.clock), kind)

    def discrete(self, kind: str) -> DataFrame:
        return staging.stage_discrete(self.raw(kind), kind)

    def discrete_all(self) -> DataFrame:
        kinds = {kind: self.discrete(kind) for kind in ("inverter", "relay")}
        return events.discrete_union(kinds, td.VALID_FROM)

    def changes(self) -> DataFrame:
        return events.state_changes(self.discrete_all())

    def events(self) -> DataFrame:
        return events.enrich_events(self.changes(), self.catalog, self.devices, self.plants)

    def half(self) -> Clock:
        return Clock(self.clock.as_of - timedelta(days=15))

    def changes_in_two_runs(self) -> tuple[DataFrame, DataFrame]:
        """Changes of the first half of the time, then those of the rest given the known states."""
        readings = self.discrete_all()
        cut = self.half().local()
        first = events.state_changes(readings.filter(F.col("timestamp") <= cut))
        rest = events.state_changes(readings.filter(F.col("timestamp") > cut), events.last_known_states(first))
        return first, rest

    def new_table(self, key: Sequence[str] = ()) -> Table:
        """A table for this query's result, which is read later; it goes when the session ends."""
        path = f"{shared_dir(self.spark)}/query-{uuid.uuid4().hex}"
        return Table(self.spark, temporary(self.spark, path), bucket_by=key, buckets=2)

    def events_upserted(self) -> DataFrame:
        """The second run starts a day early, so part of its events replace stored ones by id."""
        readings = sinks.materialize(self.spark, self.discrete_all())
        dims = (self.catalog, self.devices, self.plants)
        cut = self.half().local()
        early = Clock(self.half().as_of - timedelta(days=1)).local()
        table = self.new_table(["id"])
        first = events.enrich_events(events.state_changes(readings.filter(F.col("timestamp") <= cut)), *dims)
        table.create(sinks.with_day(first))
        known = events.last_known_states(table.read().filter(F.col("timestamp") <= early))
        again = events.state_changes(readings.filter(F.col("timestamp") > early), known)
        table.upsert(sinks.with_day(events.enrich_events(again, *dims)), ["id"])
        sinks.discard(self.spark, readings)
        return table.read().drop("date")

    def status_sources(self) -> dict[str, DataFrame]:
        return {kind: self.analog(kind) for kind in ("inverter", "logger", "meter", "relay", "weather_station")}

    def plant_status(self) -> DataFrame:
        """Only changes inside the window are worked out, from the states known before it."""
        changes = events.state_changes_after(self.discrete_all(), status.window_start(self.clock, td.WINDOW))
        happened = events.enrich_events(changes, self.catalog, self.devices, self.plants)
        return status.plant_status(self.status_sources(), happened, self.plants, self.clock, td.WINDOW)

    def availability(self, kind: str) -> DataFrame:
        readings = self.analog(kind) if kind == "inverter" else self.discrete(kind)
        return availability(
            self.devices, self.plants, readings, kind, self.clock, lookback=td.LOOKBACK, stale_after=td.STALE_AFTER
        )

    def inverter_long(self) -> DataFrame:
        return latest.latest_readings_long(self.analog("inverter"), self.clock, td.LOOKBACK)

    def latest(self, kind: str) -> DataFrame:
        lookback = td.LOOKBACK if kind == "logger" else None
        return latest.latest_readings(self.analog(kind), kind, self.clock, lookback)

    def meter_latest_merged(self) -> DataFrame:
        cut = self.half().local()
        analog = self.analog("meter")
        stored = sinks.materialize(
            self.spark, latest.latest_readings(analog.filter(F.col("timestamp") <= cut), "meter")
        )
        return latest.merge_latest(stored, analog.filter(F.col("timestamp") > cut))

    def operating_status(self) -> DataFrame:
        heard = status.recent_communication(self.inverter_long(), self.clock, td.WINDOW)
        return status.operating_status(self.plants, status.alarm_status(self.events()), heard)

    def acknowledgements(self) -> DataFrame:
        """Marks of the operators: two plants in three acknowledge every event an hour after it happened."""
        marked = self.events().filter("power_plant_id % 3 <> 0").select("id", "device_id", "timestamp")
        by = F.concat(F.lit("user"), (F.col("device_id") % 7).cast("string")).alias("acknowledged_by")
        return marked.select("id", by, (F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("acknowledged_at"))

    def acknowledged_events(self) -> DataFrame:
        return events.with_acknowledgements(self.events(), self.acknowledgements())

    def operating_status_acknowledged(self) -> DataFrame:
        heard = status.recent_communication(self.inverter_long(), self.clock, td.WINDOW)
        return status.operating_status(self.plants, status.alarm_status(self.acknowledged_events()), heard)

    def staleness(self) -> DataFrame:
        kind = "inverter"
        limits = {"lookback": td.LOOKBACK, "stale_after": td.STALE_AFTER}
        return device_staleness(self.devices, self.plants, self.analog(kind), kind, self.clock, **limits)

    def energy_now(self) -> DataFrame:
        return energy.plant_energy_now(self.analog("inverter"), self.clock, td.LOOKBACK)

    def irradiation(self) -> DataFrame:
        return performance.daily_irradiation(self.analog("weather_station"), self.clock)

    def overview(self, corrected: bool = False) -> DataFrame:
        """Bounded parts filter on time before they stage, so sharing one staged table would cost more."""
        read = self.analog_corrected if corrected else self.analog
        inverter, weather, relay = self.analog("inverter"), self.analog("weather_station"), self.discrete("relay")
        kinds = {"inverter": self.discrete("inverter"), "relay": relay}
        happened = events.detect_state_changes(
            kinds, self.catalog, self.devices, self.plants, valid_from=td.VALID_FROM
        )
        limits = {"lookback": td.LOOKBACK, "stale_after": td.STALE_AFTER}
        return plants_overview(
            self.plants,
            latest.latest_readings(weather, "weather_station"),
            availability(self.devices, self.plants, inverter, "inverter", self.clock, **limits),
            availability(self.devices, self.plants, relay, "relay", self.clock, **limits),
            happened,
            latest.latest_readings_long(inverter, self.clock, td.LOOKBACK),
            read("inverter") if corrected else inverter,
            read("weather_station") if corrected else weather,
            self.clock,
            lookback=td.LOOKBACK,
            window=td.WINDOW,
            report_daily_energy=not corrected,
        )

    def first_batch(self, kind: str, key: Sequence[str] = ()) -> tuple[Table, DataFrame]:
        """A table with the staged readings of the first half of the arrivals, and all raw rows."""
        table, raw = self.new_table(key), self.raw(kind)
        first = staging.stage_analog(raw.filter(F.col("timestamp") <= self.half().instant()), kind)
        table.create(sinks.with_day(first))
        return table, raw

    def appended(self) -> DataFrame:
        table, raw = self.first_batch("relay")
        rest = staging.stage_analog(incremental.incremental_filter(raw, self.half().as_of), "relay")
        table.append(sinks.with_day(rest))
        return table.read().drop("date")

    def appended_local_watermark(self) -> DataFrame:
        table, raw = self.first_batch("inverter")
        done = incremental.watermark_of(table.read())
        rest = staging.stage_analog(incremental.incremental_filter_local(raw, done), "inverter")
        table.append(sinks.with_day(rest))
        return table.read().drop("date")

    def upserted(self) -> DataFrame:
        table, raw = self.first_batch("meter", ["device_id", "timestamp"])
        rest = incremental.incremental_filter(raw, self.half().as_of, allowed_lateness="1 hour")
        table.upsert(sinks.with_day(staging.stage_analog(rest, "meter")), ["device_id", "timestamp"])
        return table.read().drop("date")

    def synced(self) -> DataFrame:
        """A second load without one column and with another: stored rows keep their files and show NULL."""
        table, raw = self.first_batch("relay", ["device_id", "timestamp"])
        rest = staging.stage_analog(incremental.incremental_filter(raw, self.half().as_of), "relay")
        changed = rest.drop("line_voltage_ca").withColumn("half_power", F.col("active_power") / 2)
        table.upsert(sinks.with_day(changed), ["device_id", "timestamp"], on_schema_change="sync")
        return table.read().drop("date")

    def energy_replaced(self, by_plant: bool) -> DataFrame:
        """Stored series with the days of the recompute window deleted and put in again."""
        compute = energy.plant_daily_energy if by_plant else energy.daily_energy
        keys = ["date", "power_plant_id"] if by_plant else ["date"]
        table, analog = self.new_table(), sinks.materialize(self.spark, self.analog("inverter"))
        yesterday = Clock(self.clock.as_of - timedelta(days=1)).local()
        table.create(compute(analog.filter(F.col("timestamp") <= yesterday)))
        table.upsert(compute(energy.energy_window(analog, self.clock)), keys)
        sinks.discard(self.spark, analog)
        return table.read()

    def grid_values(self) -> DataFrame:
        def extracted(kind: str) -> DataFrame:
            fields = ["active_power", "cumulative_active_energy", "state_simplified", "state_operation", "frequency"]
            parsed = self.raw(kind).select("timestamp", "device_id", payload_struct(F.col("json_data"), fields).alias("p"))
            return parsed.select(
                "timestamp",
                "device_id",
                grid_value("p.active_power").alias("as_float"),
                grid_value("p.cumulative_active_energy", "DECIMAL2").alias("as_decimal"),
                grid_value("p.state_simplified", "INTEGER").alias("as_integer"),
                grid_value("p.state_operation", "BIGINT").alias("as_bigint"),
                grid_value("p.frequency").alias("frequency"),
                grid_value("p.active_power", "TEXT").alias("as_text"),
            )

        first, *others = (extracted(kind) for kind in td.KINDS)
        for other in others:
            first = first.unionByName(other)
        return first

    def _raw_view(self, kind: str) -> str:
        """A view of raw rows, and the functions, for queries in SQL."""
        register(self.spark)
        name = f"raw_{kind}_{uuid.uuid4().hex}"
        self.raw(kind).createOrReplaceTempView(name)
        return name

    def grid_values_in_sql(self) -> DataFrame:
        """The fields of ``grid_value_extract`` as a SQL user takes them out.

        Each device type has its own SELECT: Spark 4.1 fails on several SQL functions above one UNION.
        """
        return self.spark.sql(" UNION ALL ".join(f"""
            SELECT timestamp, device_id,
                   extract_grid_value(json_data, 'active_power') AS as_float,
                   extract_grid_decimal(json_data, 'cumulative_active_energy') AS as_decimal,
                   extract_grid_integer(json_data, 'state_simplified') AS as_integer,
                   extract_grid_bigint(json_data, 'state_operation') AS as_bigint,
                   extract_grid_value(json_data, 'frequency') AS frequency,
                   extract_grid_text(json_data, 'active_power') AS as_text
            FROM {self._raw_view(kind)}""" for kind in td.KINDS))

    def code_counts_in_sql(self) -> DataFrame:
        """How often each field of the relay payloads has each on/off text."""
        return self.spark.sql(f"""
            SELECT p.field, p.value, count(*) AS readings
            FROM {self._raw_view("relay")} r, LATERAL grid_value_pairs(r.json_data) p
            WHERE p.value IN ('0', '1', 'true', 'false') GROUP BY p.field, p.value""")

    def rejected(self) -> DataFrame:
        first, *others = (self.discrete(kind) for kind in ("inverter", "relay", "tracker"))
        for other in others:
            first = first.unionByName(other)
        return events.rejected_codes(first)

    def source_checks(self) -> DataFrame:
        tables = {f"raw_{kind}": self.raw(kind) for kind in td.KINDS}
        tables |= {"tb_power_plants": self.plants, "tb_devices": self.devices, "tb_event_alarm_catalog": self.catalog}
        return quality.declared_checks(tables)

    def raw_copies(self) -> DataFrame:
        typed = staging.typed_readings(self.raw("inverter"), "inverter")
        return quality.duplicate_audit(typed, ["device_id", "timestamp"])


_QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "grid_value_extract": Models.grid_values,
    "grid_value_sql": Models.grid_values_in_sql,
    "code_counts_sql": Models.code_counts_in_sql,
    **{f"stg_{name}_analog": (lambda m, kind=kind: m.analog(kind)) for name, kind in _WIDE.items()},
    "stg_inverter_analog_corrected": lambda m: m.analog_corrected("inverter"),
    "stg_weather_analog_corrected": lambda m: m.analog_corrected("weather_station"),
    **{f"stg_{kind}_discrete": (lambda m, kind=kind: m.discrete(kind)) for kind in ("inverter", "relay", "tracker")},
    "string_currents_latest": lambda m: staging.latest_string_currents(m.raw("inverter"), m.devices, td.VALID_FROM),
    "state_changes": Models.changes,
    "state_changes_incremental": lambda m: m.changes_in_two_runs()[1],
    "last_known_states": lambda m: events.last_known_states(m.changes()),
    "rejected_codes": Models.rejected,
    "events_enriched": Models.events,
    "plant_status": Models.plant_status,
    **{f"{kind}_availability": (lambda m, kind=kind: m.availability(kind)) for kind in ("inverter", "relay", "tracker")},
    "inverter_latest_long": Models.inverter_long,
    **{f"{name}_latest": (lambda m, kind=kind: m.latest(kind)) for name, kind in _WIDE.items() if name != "inverter"},
    "latest_merged": Models.meter_latest_merged,
    "daily_energy": lambda m: energy.daily_energy(m.analog("inverter")),
    "plant_daily_energy": lambda m: energy.plant_daily_energy(m.analog("inverter")),
    "energy_window": lambda m: energy.daily_energy(energy.energy_window(m.analog("inverter"), m.clock)),
    "alarm_status": lambda m: status.alarm_status(m.events()),
    "plant_comm_status": lambda m: status.recent_communication(m.inverter_long(), m.clock, td.WINDOW),
    "operating_status": Models.operating_status,
    "events_acknowledged": Models.acknowledged_events,
    "operating_status_acknowledged": Models.operating_status_acknowledged,
    "device_staleness": Models.staleness,
    "active_power_by_plant": lambda m: performance.active_power_by_plant(m.inverter_long()),
    "plant_energy_now": Models.energy_now,
    "daily_irradiation": Models.irradiation,
    "performance_ratio": lambda m: performance.performance_ratio_by_plant(m.plants, m.energy_now(), m.irradiation()),
    "plants_overview": Models.overview,
    "plants_overview_corrected": lambda m: m.overview(corrected=True),
    "incremental_append": Models.appended,
    "incremental_append_tz": Models.appended_local_watermark,
    "delete_insert_days": lambda m: m.energy_replaced(by_plant=False),
    "delete_insert_plant_days": lambda m: m.energy_replaced(by_plant=True),
    "keyed_upsert": Models.upserted,
    "event_upsert": Models.events_upserted,
    "synced_columns": Models.synced,
    "retention_filter": lambda m: incremental.retain(m.analog("inverter"), m.clock, td.HORIZON),
    "month_to_date": lambda m: incremental.month_to_date(m.raw("weather_station"), m.data.second_clock()),
    "horizon_filter": lambda m: incremental.within_horizon(
        m.raw("weather_station"), m.data.second_clock(), td.HORIZON
    ).drop("json_data"),
    "not_null_report": lambda m: quality.not_null_report(m.analog("inverter"), _REPORTED),
    "unique_report": lambda m: quality.unique_report(m.events(), [["id"], ["device_id", "timestamp"]]),
    "accepted_range_report": lambda m: quality.accepted_range_report(
        m.analog("inverter"),
        {"frequency": (60.04, 61.0), "efficiency": (0, 100), "temperature_internal": (-10, 100)},
    ),
    "accepted_values_report": lambda m: quality.accepted_values_report(
        m.analog("inverter"), {"state_operation": [0, 1, 2, 3, 4, 5], "state_simplified": [0, 1, 2]}
    ),
    "relationships_report": lambda m: quality.relationships_report(
        m.analog("inverter"), "device_id", m.devices.filter("is_active"), "id"
    ),
    "source_checks": Models.source_checks,
    "freshness_report": lambda m: quality.freshness_report({f"raw_{kind}": m.raw(kind) for kind in td.KINDS}, m.clock),
    "duplicate_audit": Models.raw_copies,
    "device_last_24h": lambda m: adhoc.device_history(m.analog("inverter"), 1, m.clock, td.LOOKBACK),
    "newest_readings": lambda m: adhoc.newest_readings(m.analog("inverter")),
    "last_processed": lambda m: adhoc.last_processed(m.analog("inverter")),
    "daily_counts": lambda m: adhoc.daily_counts(m.analog("inverter")),
}


def _naive_utc(df: DataFrame) -> DataFrame:
    """Instants as naive UTC times, so that results compare without a time zone."""
    instants = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(instants) if instants else df


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where their subpackage has been taken out."""
    try:
        import corpus_pipeline
        import helioframe.llm.queries as llm
    except ModuleNotFoundError as gone:
        if gone.name not in ("corpus_pipeline", "helioframe.llm", "helioframe.llm.queries"):
            raise
        return {}, {}
    sql = dict(llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each registered query takes a session and a test-data folder."""
    telemetry = {
        name: (lambda spark, folder, build=build: _naive_utc(build(Models(spark, folder))))
        for name, build in _QUERIES.items()
    }
    return {**telemetry, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    from oracles import oracle_sql as sql

    return {**sql(), **_training_data()[1]}


def entry(spark: SparkSession) -> DataFrame:
    """The plant overview over the smallest test data."""
    return queries()["plants_overview"](spark, SMOKE_DIR)
