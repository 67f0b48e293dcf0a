"""Field lists, device types and thresholds, as data.

Everything in this module is a fixed value: names, units and limits that the plant data itself uses.
"""

from __future__ import annotations

from dataclasses import dataclass

FLOAT, DECIMAL2, INTEGER = "FLOAT", "DECIMAL2", "INTEGER"

# Device type ids.
DEVICE_TYPES = {
    "inverter": 1,
    "relay": 2,
    "logger": 3,
    "tracker": 4,
    "weather_station": 5,
    "meter": 6,
    "transformer": 7,
    "nobreak": 8,
}

IDS = ("timestamp", "power_plant_id", "device_id")

# Analog fields per device type, in output order, with the type each one is stored as.
ANALOG_FIELDS: dict[str, tuple[tuple[str, str], ...]] = {
    "inverter": (
        ("active_power", FLOAT),
        ("power_reactive", FLOAT),
        ("power_input", FLOAT),
        ("power_factor", FLOAT),
        ("daily_active_energy", DECIMAL2),
        ("cumulative_active_energy", DECIMAL2),
        ("frequency", FLOAT),
        ("efficiency", FLOAT),
        ("current_phase_a", FLOAT),
        ("current_phase_b", FLOAT),
        ("current_phase_c", FLOAT),
        ("line_voltage_ab", FLOAT),
        ("line_voltage_bc", FLOAT),
        ("line_voltage_ca", FLOAT),
        ("string_voltage", FLOAT),
        ("temperature_internal", DECIMAL2),
        ("resistance_insulation", DECIMAL2),
        ("state_operation", INTEGER),
        ("state_simplified", INTEGER),
    ),
    "relay": (
        ("active_power", FLOAT),
        ("line_voltage_ab", FLOAT),
        ("line_voltage_bc", FLOAT),
        ("line_voltage_ca", FLOAT),
        ("apparent_power", FLOAT),
        ("power_reactive", FLOAT),
        ("current_phase_a", FLOAT),
        ("current_phase_b", FLOAT),
        ("current_phase_c", FLOAT),
    ),
    "logger": (
        ("active_power", FLOAT),
        ("daily_active_energy", FLOAT),
        ("cumulative_active_energy", FLOAT),
        ("power_reactive", FLOAT),
        ("dc_input_power", FLOAT),
        ("active_power_limit", FLOAT),
        ("power_factor", FLOAT),
        ("efficiency", FLOAT),
        ("dc_current", FLOAT),
        ("current_phase_a", FLOAT),
        ("current_phase_b", FLOAT),
        ("current_phase_c", FLOAT),
        ("line_voltage_ab", FLOAT),
        ("line_voltage_bc", FLOAT),
        ("line_voltage_ca", FLOAT),
        ("inverters_producing_count", INTEGER),
        ("logger_state", INTEGER),
        ("operation_state", INTEGER),
        ("breaker_position", INTEGER),
    ),
    "meter": (
        ("active_power", FLOAT),
        ("power_reactive", FLOAT),
        ("apparent_power", FLOAT),
        ("power_factor", FLOAT),
        ("exported_active_energy", FLOAT),
        ("imported_active_energy", FLOAT),
        ("exported_reactive_energy", FLOAT),
        ("imported_reactive_energy", FLOAT),
        ("frequency", FLOAT),
        ("current_phase_a", FLOAT),
        ("current_phase_b", FLOAT),
        ("current_phase_c", FLOAT),
        ("line_voltage_ab", FLOAT),
        ("line_voltage_bc", FLOAT),
        ("line_voltage_ca", FLOAT),
    ),
    "weather_station": (
        ("irradiance_ghi", DECIMAL2),
        ("irradiance_poa", DECIMAL2),
        ("air_temperature", FLOAT),
        ("module_temperature", DECIMAL2),
        ("rain_signal", FLOAT),
        ("accumulated_rain", DECIMAL2),
        ("hourly_accumulated_rain", DECIMAL2),
        ("monthly_accumulated_rain", FLOAT),
    ),
    "tracker": (
        ("posat", FLOAT),
        ("posal", FLOAT),
    ),
}

# Text fields kept beside the analog ones.
TEXT_FIELDS = {"inverter": ("serial_number",)}


def analog_columns(kind: str) -> list[str]:
    """Column contract of a staged analog table."""
    return [*IDS, *TEXT_FIELDS.get(kind, ()), *(name for name, _ in ANALOG_FIELDS[kind])]


@dataclass(frozen=True)
class DiscreteRule:
    """Which payload keys count as discrete codes.

    ``excluded`` keys never do; with ``codes_only`` a key must also be all digits or be in ``named``.
    """

    excluded: tuple[str, ...]
    codes_only: bool = False
    named: tuple[str, ...] = ()


DISCRETE_RULES = {
    "inverter": DiscreteRule(
        excluded=("timestamp", *(name for name, _ in ANALOG_FIELDS["inverter"])),
        codes_only=True,
        named=("communication_failure",),
    ),
    "relay": DiscreteRule(excluded=("timestamp", *(name for name, _ in ANALOG_FIELDS["relay"]))),
    "tracker": DiscreteRule(excluded=("timestamp", *(name for name, _ in ANALOG_FIELDS["tracker"]))),
}

# Dashboard list of inverter readings: label, column, unit; the position is the display order.
INVERTER_DISPLAY = (
    ("Active Power", "active_power", "kW"),
    ("Reactive Power", "power_reactive", "kVAr"),
    ("Input Power", "power_input", "kW"),
    ("Power Factor", "power_factor", ""),
    ("Rendimento de energia ativa diário", "daily_active_energy", "kWh"),
    ("Rendimento de energia ativa acumulada", "cumulative_active_energy", "kWh"),
    ("Frequency", "frequency", "Hz"),
    ("Efficiency", "efficiency", "%"),
    ("Current: Phase A", "current_phase_a", "A"),
    ("Current: Phase B", "current_phase_b", "A"),
    ("Current: Phase C", "current_phase_c", "A"),
    ("Voltage: AB line", "line_voltage_ab", "V"),
    ("Voltage: BC line", "line_voltage_bc", "V"),
    ("Voltage: CA line", "line_voltage_ca", "V"),
    ("Tensão String", "string_voltage", "V"),
    ("Temperature: internal", "temperature_internal", "°C"),
    ("Resistance: insulation", "resistance_insulation", "MOhm"),
    ("State: Operation", "state_operation", ""),
    ("State: Simplified", "state_simplified", ""),
)

STRINGS_PER_INVERTER = 32

# Time limits, as interval text.
COMMUNICATION_WINDOW = "30 minutes"
STALE_AFTER = "15 minutes"
READING_LOOKBACK = "1 hour"
WEATHER_HORIZON = "2 months"
ENERGY_RECOMPUTE = "3 days"
RETENTION = "1 year"
COMPACT_AFTER = "7 days"
FRESHNESS_WARN = "10 minutes"
FRESHNESS_ERROR = "30 minutes"

# Readings older than this were of poor quality and are left out of events and string currents.
VALID_FROM = "2026-01-06 00:00:00"

# Five-minute samples, so twelve an hour: their sum over twelve is watt-hours.
IRRADIANCE_SAMPLES_PER_HOUR = 12
REFERENCE_IRRADIANCE = 1000.0
EXCLUDED_IRRADIANCE_DEVICES = (5,)

# Texts that carry an on/off state.
BINARY_TEXTS = {"0": 0, "1": 1, "true": 1, "false": 0}

_RAW_NOT_NULL = ("timestamp", "power_plant_id", "device_id", "json_data")
_CODES_NOT_NULL = (*IDS, "discrete_data_json")

# Declared checks per table: columns that are never NULL, and columns whose values never repeat.
DECLARED_CHECKS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    **{f"raw_{kind}": (_RAW_NOT_NULL, ()) for kind in ANALOG_FIELDS},
    "tb_power_plants": (("id", "customer_id", "name"), ("id",)),
    "tb_devices": (("id", "device_type_id", "power_plant_id"), ("id",)),
    "tb_event_alarm_catalog": (
        ("id", "device_type_id", "code", "value", "description", "type", "severity", "is_active"),
        (),
    ),
    **{f"stg_{kind}_analogic_data": (IDS, ()) for kind in ANALOG_FIELDS},
    "stg_inverter_analogic_data": (
        (*IDS, "active_power", "power_reactive", "state_operation", "state_simplified"),
        (),
    ),
    **{f"stg_{kind}_discrete_data": (_CODES_NOT_NULL, ()) for kind in DISCRETE_RULES},
    "stg_inverter_string_data": ((*IDS, "string_number"), ()),
    "int_events_alarms": (
        (
            "timestamp",
            "power_plant_id",
            "device_id",
            "device_type_id",
            "code",
            "value",
            "description",
            "type",
            "severity",
            "acknowledged",
            "id",
        ),
        ("id",),
    ),
    "int_power_plant_status": (
        ("power_plant_id", "power_plant_status", "has_critical_alarm", "calculated_at"),
        (),
    ),
    "int_inverter_availability": (("power_plant_id",), ("power_plant_id",)),
    "int_relay_availability": (("power_plant_id",), ("power_plant_id",)),
    "int_inverter_latest_readings": (("device_id", "power_plant_id", "field_name", "timestamp"), ()),
    **{
        f"int_{kind}_latest_readings": (("device_id", "power_plant_id", "timestamp"), ())
        for kind in ("logger", "meter", "relay", "weather_station")
    },
    "int_inverter_daily_energy_timeseries": (
        ("date", "total_energy_kwh", "total_active_inverters", "total_power_plants"),
        ("date",),
    ),
    "mart_power_plants_overview": (("power_plant_id", "power_plant_name", "updated_at"), ("power_plant_id",)),
}

# Keys that span columns, from the tables' unique indexes.
TABLE_KEYS = {
    "int_inverter_daily_energy_timeseries": ("date",),
    "int_inverter_power_plant_daily_energy_timeseries": ("date", "power_plant_id"),
}

# Documented ranges and values of inverter readings.
INVERTER_RANGES = {"frequency": (59.0, 61.0), "efficiency": (0, 100), "temperature_internal": (-10, 100)}
INVERTER_VALUES = {"state_operation": (0, 1, 2, 3, 4, 5)}
