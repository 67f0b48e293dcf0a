"""DuckDB SQL that gives what each registered query must give, on the same Parquet tables."""

from __future__ import annotations

from helioframe.sources import testdata as td
from helioframe.specs import ANALOG_FIELDS, DEVICE_TYPES, INVERTER_DISPLAY, WEATHER_HORIZON

_VALID_FROM = f"TIMESTAMP '{td.VALID_FROM}'"
_SECOND = f"TIMESTAMP '{td.SECOND_CLOCK}'"


def _interval(text: str) -> str:
    count, unit = text.split()
    return f"INTERVAL {count} {unit}"


_LOOKBACK = f"(SELECT local_now - {_interval(td.LOOKBACK)} FROM clock)"
_STALE = f"(SELECT local_now - {_interval(td.STALE_AFTER)} FROM clock)"
_WINDOW = f"(SELECT local_now - {_interval(td.WINDOW)} FROM clock)"


def _text(key: str, json: str = "json_data") -> str:
    return f"""json_extract_string({json}, '$."{key}"')"""


def _number(text: str, kind: str) -> str:
    head = f"nullif(nullif(split_part({text}, '@', 1), ''), '-')"
    if kind == "FLOAT":
        return f"try_cast({head} AS DOUBLE)"
    exact = f"try_cast({head} AS DECIMAL(38,18))"
    if kind == "DECIMAL2":
        return f"CAST(round({exact}, 2) AS DECIMAL(18,2))"
    return f"CAST(round({exact}, 0) AS INTEGER)"


_LOCAL = f"CAST({_text('timestamp')} AS TIMESTAMP) - INTERVAL 3 HOURS"


def _stage(kind: str, source: str) -> str:
    serial = f", nullif(trim({_text('serial_number')}), '') AS serial_number" if kind == "inverter" else ""
    fields = ", ".join(f"{_number(_text(name), target)} AS {name}" for name, target in ANALOG_FIELDS[kind])
    return f"""SELECT * EXCLUDE (arrived) FROM (
        SELECT timestamp AS arrived, {_LOCAL} AS timestamp, power_plant_id, device_id{serial}, {fields} FROM {source})
        QUALIFY row_number() OVER (PARTITION BY device_id, timestamp ORDER BY arrived DESC) = 1"""


def _json_value() -> str:
    # Every value keeps its type; a JSON number comes back from Spark without zeros at the end of its fraction.
    raw = "json_extract_string(json_data, '$.\"' || key || '\"')"
    kind = "json_type(json_data, '$.\"' || key || '\"')"
    number = f"regexp_replace(CAST(CAST({raw} AS DOUBLE) AS VARCHAR), '[.]0$', '')"
    return f"CASE {kind} WHEN 'DOUBLE' THEN {number} WHEN 'VARCHAR' THEN '\"' || {raw} || '\"' ELSE {raw} END"


def _discrete(kind: str, source: str) -> str:
    excluded = ", ".join(f"'{name}'" for name in ("timestamp", *(name for name, _ in ANALOG_FIELDS[kind])))
    wanted = f"key NOT IN ({excluded})"
    if kind == "inverter":
        wanted += " AND (regexp_full_match(key, '[0-9]+') OR key = 'communication_failure')"
    return f"""SELECT * EXCLUDE (arrived) FROM (
        SELECT r.timestamp AS arrived, {_LOCAL.replace('json_data', 'r.json_data')} AS timestamp, r.power_plant_id, r.device_id,
               d.discrete_data_json
        FROM {source} r LEFT JOIN (
            SELECT device_id, timestamp,
                   '{{' || string_agg('"' || key || '":' || {_json_value()}, ',' ORDER BY place) || '}}' AS discrete_data_json
            FROM (SELECT device_id, timestamp, json_data, unnest(json_keys(json_data)) AS key,
                         generate_subscripts(json_keys(json_data), 1) AS place FROM {source})
            WHERE {wanted} GROUP BY device_id, timestamp) d
        ON d.device_id = r.device_id AND d.timestamp = r.timestamp)
        QUALIFY row_number() OVER (PARTITION BY device_id, timestamp ORDER BY arrived DESC) = 1"""


def _availability(kind: str, readings: str, plural: str, test: str) -> str:
    return f"""SELECT t.power_plant_id, t.total AS total_{plural}, coalesce(a.active, 0) AS active_{plural},
        coalesce(a.inactive, 0) AS inactive_{plural},
        coalesce(a.stale, 0) + (t.total - coalesce(a.active, 0) - coalesce(a.inactive, 0) - coalesce(a.stale, 0)) AS no_data_{plural},
        CAST(round(CAST(coalesce(a.active, 0) * 100.0 / t.total AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) AS availability_pct
    FROM (SELECT d.power_plant_id, count(*) AS total FROM tb_devices d JOIN tb_power_plants p ON d.power_plant_id = p.id
          WHERE d.device_type_id = {DEVICE_TYPES[kind]} AND d.is_active AND p.is_active GROUP BY 1) t
    LEFT JOIN (
        SELECT power_plant_id, count(*) FILTER (WHERE act) AS active, count(*) FILTER (WHERE NOT act AND NOT stale) AS inactive,
               count(*) FILTER (WHERE stale) AS stale
        FROM (SELECT power_plant_id, coalesce({test} AND timestamp > {_STALE}, false) AS act, timestamp <= {_STALE} AS stale
              FROM (SELECT DISTINCT ON (device_id) * FROM {readings} WHERE timestamp > {_LOOKBACK}
                    ORDER BY device_id, timestamp DESC))
        GROUP BY 1) a ON a.power_plant_id = t.power_plant_id"""


def _latest(table: str, where: str = "") -> str:
    return f"SELECT DISTINCT ON (device_id) * FROM {table} {where} ORDER BY device_id, timestamp DESC"


def _changes(exploded: str) -> str:
    return f"""SELECT timestamp, power_plant_id, device_id, device_type_id, code, value FROM (
        SELECT *, lag(value) OVER (PARTITION BY device_id, code ORDER BY timestamp) AS previous FROM {exploded})
        WHERE previous IS NULL OR value <> previous"""


def _overview(inverter: str, weather: str, weather_latest: str, energy: str) -> str:
    return f"""SELECT p.id AS power_plant_id, p.name AS power_plant_name, p.capacity AS rated_power_kw,
        CAST(CASE WHEN s.power_plant_status = 'no_communication' THEN 0 ELSE coalesce(ap.active_power_kw, 0) END AS DECIMAL(28,2)) AS active_power_kw,
        {energy} AS daily_energy_kwh,
        CAST(coalesce(w.irradiance_poa, 0) AS DECIMAL(18,2)) AS irradiance_wm2,
        CAST(coalesce(ia.availability_pct, 0) AS DECIMAL(18,2)) AS inverter_availability_pct,
        CAST(coalesce(ra.availability_pct, 0) AS DECIMAL(18,2)) AS rates_availability_pct,
        s.power_plant_status, pr.pr_pct, p.location,
        CAST(NULL AS TIMESTAMP) AS meter_last_reading_timestamp, CAST(NULL AS TIMESTAMP) AS logger_last_reading_timestamp,
        w.timestamp AS weather_last_reading_timestamp, (SELECT as_of FROM clock) AS updated_at
    FROM tb_power_plants p
    LEFT JOIN (SELECT DISTINCT ON (power_plant_id) * FROM {weather_latest} ORDER BY power_plant_id, timestamp DESC, device_id) w ON w.power_plant_id = p.id
    LEFT JOIN inverter_availability ia ON ia.power_plant_id = p.id
    LEFT JOIN relay_availability ra ON ra.power_plant_id = p.id
    LEFT JOIN operating_status s ON s.power_plant_id = p.id
    LEFT JOIN active_power ap ON ap.power_plant_id = p.id
    LEFT JOIN ({_energy_now(inverter)}) et ON et.power_plant_id = p.id
    LEFT JOIN ({_performance(inverter, weather)}) pr ON pr.power_plant_id = p.id
    WHERE p.is_active"""


def _energy_now(inverter: str) -> str:
    return f"""SELECT power_plant_id, CAST(sum(daily_active_energy) AS DECIMAL(28,2)) AS et_kwh FROM (
        SELECT DISTINCT ON (device_id) * FROM {inverter} WHERE daily_active_energy IS NOT NULL AND timestamp > {_LOOKBACK}
        ORDER BY device_id, timestamp DESC) GROUP BY 1"""


def _irradiation(weather: str) -> str:
    return f"""SELECT power_plant_id, CAST(sum(irradiance_poa) AS DOUBLE) / CAST(12.0 AS DOUBLE) AS ht_kwh_m2 FROM {weather}
        WHERE CAST(timestamp AS DATE) = (SELECT CAST(local_now AS DATE) FROM clock) AND irradiance_poa IS NOT NULL AND device_id <> 5
        GROUP BY 1"""


def _performance(inverter: str, weather: str) -> str:
    return f"""SELECT p.id AS power_plant_id, p.capacity AS rated_power_kw, et.et_kwh, ht.ht_kwh_m2,
        CASE WHEN p.capacity > 0 AND coalesce(ht.ht_kwh_m2, 0) > 0 THEN
            CAST(round(CAST((CAST(coalesce(et.et_kwh, 0) AS DOUBLE) / p.capacity) * (CAST(1000.0 AS DOUBLE) / ht.ht_kwh_m2) * CAST(100.0 AS DOUBLE)
                 AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) END AS pr_pct
    FROM tb_power_plants p LEFT JOIN ({_energy_now(inverter)}) et ON et.power_plant_id = p.id
    LEFT JOIN ({_irradiation(weather)}) ht ON ht.power_plant_id = p.id WHERE p.is_active"""


def _fixture() -> list[tuple[str, str]]:
    ctes = [
        (
            "base",
            f"""SELECT *, CAST(device_id AS VARCHAR) AS device_text, CAST(v AS VARCHAR) AS v_text, CAST(v * 100 AS BIGINT) AS cents,
            strftime(ts, '%Y%m%d%H%M%S') AS tag, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS payload_time
            FROM (SELECT ts, user_id + 1 AS device_id, CAST(user_id % 6 + 1 AS INTEGER) AS device_type_id,
                         (user_id // 6) % {td.PLANTS} + 1 AS power_plant_id,
                         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(value AS DECIMAL(18,2)) AS v FROM events)""",
        ),
        (
            "clock",
            """SELECT as_of, as_of - INTERVAL 3 HOURS AS local_now FROM (
            SELECT date_trunc('hour', max(ts)) + INTERVAL 10 MINUTES AS as_of FROM events)""",
        ),
        (
            "tb_power_plants",
            """SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS customer_id, n_name AS name,
            CAST(1000 + 100 * n_nationkey AS DOUBLE) AS capacity, n_name AS location, n_nationkey % 5 <> 4 AS is_active FROM nation""",
        ),
        (
            "tb_devices",
            f"""SELECT c_custkey + 1 AS id, CAST(c_custkey % 6 + 1 AS INTEGER) AS device_type_id,
            (c_custkey // 6) % {td.PLANTS} + 1 AS power_plant_id, c_name AS device_name, c_custkey % 11 <> 0 AS is_active
            FROM customer""",
        ),
        (
            "catalog",
            "SELECT * FROM (VALUES "
            + ", ".join(
                f"({kind}, '{code}', {value}, '{code} is {value}', '{label}', '{severity}', {str(active).lower()})"
                for kind, code, value, label, severity, active in td.CATALOG
            )
            + ") AS c(device_type_id, code, value, description, type, severity, is_active)",
        ),
    ]
    for kind in td.KINDS:
        ctes.append(
            (
                f"raw_{kind}",
                f"""SELECT ts AS timestamp, power_plant_id, device_id, {td.payload_sql(kind, '//', 'VARCHAR')} AS json_data
                FROM base WHERE device_type_id = {DEVICE_TYPES[kind]}""",
            )
        )
    for kind in td.KINDS:
        source = f"raw_{kind}"
        if kind == "weather_station":
            source = f"(SELECT * FROM raw_{kind} WHERE timestamp >= (SELECT as_of - {_interval(WEATHER_HORIZON)} FROM clock))"
        ctes.append((f"stg_{kind}", _stage(kind, source)))
    for kind in ("inverter", "weather_station"):
        month = f"(SELECT * FROM raw_{kind} WHERE timestamp >= (SELECT date_trunc('month', as_of) FROM clock))"
        ctes.append((f"stg_{kind}_month", _stage(kind, month)))
    for kind in ("inverter", "relay", "tracker"):
        ctes.append((f"disc_{kind}", _discrete(kind, f"raw_{kind}")))
    ctes += [
        (
            "exploded",
            f"""SELECT timestamp, power_plant_id, device_id, device_type_id, code,
                CASE text WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE CAST(text AS INTEGER) END AS value
            FROM (SELECT timestamp, power_plant_id, device_id, device_type_id, code,
                         json_extract_string(discrete_data_json, '$."' || code || '"') AS text
                  FROM (SELECT *, unnest(json_keys(discrete_data_json)) AS code FROM (
                        SELECT *, 1 AS device_type_id FROM disc_inverter WHERE timestamp >= {_VALID_FROM} AND discrete_data_json IS NOT NULL
                        UNION ALL
                        SELECT *, 2 AS device_type_id FROM disc_relay WHERE timestamp >= {_VALID_FROM} AND discrete_data_json IS NOT NULL)))
            WHERE text IN ('0', '1', 'true', 'false')""",
        ),
        ("changes", _changes("exploded")),
        (
            "ev",
            """SELECT CAST(abs(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END) AS BIGINT) AS id,
                e.timestamp, e.power_plant_id, e.power_plant_name, e.device_id, e.device_name, e.device_type_id, e.code, e.value,
                coalesce(e.description, 'Código "' || e.code || '" não cadastrado (device_type_id=' || e.device_type_id || ', value=' || e.value || ')') AS description,
                coalesce(e.type, 'alarm') AS type, coalesce(e.severity, 'high') AS severity, false AS acknowledged,
                CAST(NULL AS VARCHAR) AS acknowledged_by, CAST(NULL AS TIMESTAMP) AS acknowledged_at
            FROM (SELECT x.*, p.name AS power_plant_name, d.device_name, c.description, c.type, c.severity,
                         CAST(('0x' || left(md5(CAST(x.device_id AS VARCHAR) || CAST(x.timestamp AS VARCHAR) || x.code), 16)) AS HUGEINT) AS h
                  FROM changes x
                  LEFT JOIN catalog c ON c.code = x.code AND c.value = x.value AND c.device_type_id = x.device_type_id AND c.is_active
                  LEFT JOIN tb_devices d ON d.id = x.device_id LEFT JOIN tb_power_plants p ON p.id = x.power_plant_id) e""",
        ),
        (
            "inverter_availability",
            _availability("inverter", "stg_inverter", "inverters", "state_simplified = 2"),
        ),
        (
            "relay_availability",
            _availability(
                "relay",
                "disc_relay",
                "relays",
                f"{_number(_text('breaker_position', 'discrete_data_json'), 'INTEGER')} = 1 AND "
                f"{_number(_text('communication_failure', 'discrete_data_json'), 'INTEGER')} = 1",
            ),
        ),
        (
            "tracker_availability",
            _availability(
                "tracker", "disc_tracker", "trackers", f"{_number(_text('flh_com', 'discrete_data_json'), 'INTEGER')} = 0"
            ),
        ),
        ("inv_newest", _latest("stg_inverter", f"WHERE timestamp > {_LOOKBACK}")),
        (
            "inv_long",
            "SELECT device_id, power_plant_id, field_name, value_numeric, CAST(value_numeric AS VARCHAR) || ' ' || unit AS value_formatted,"
            " unit, timestamp, display_order FROM ("
            + " UNION ALL ".join(
                f"SELECT device_id, power_plant_id, timestamp, '{label}' AS field_name, "
                f"CAST(round(CAST({column} AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) AS value_numeric, '{unit}' AS unit, {place} AS display_order FROM inv_newest"
                for place, (label, column, unit) in enumerate(INVERTER_DISPLAY, start=1)
            )
            + ") WHERE value_numeric IS NOT NULL",
        ),
        (
            "alarms",
            """SELECT power_plant_id, bool_or(NOT acknowledged) AS has_unacknowledged_alarm, true AS has_high_alarm FROM (
            SELECT DISTINCT ON (power_plant_id, device_id, code) * FROM ev ORDER BY power_plant_id, device_id, code, timestamp DESC)
            WHERE type = 'alarm' AND severity = 'high' GROUP BY 1""",
        ),
        ("heard", f"SELECT power_plant_id, max(timestamp) AS last_communication FROM inv_long WHERE timestamp > {_WINDOW} GROUP BY 1"),
        (
            "ev_marked",
            """SELECT * REPLACE (power_plant_id % 3 <> 0 AS acknowledged,
                CASE WHEN power_plant_id % 3 <> 0 THEN 'user' || CAST(device_id % 7 AS VARCHAR) END AS acknowledged_by,
                CASE WHEN power_plant_id % 3 <> 0 THEN timestamp + INTERVAL 1 HOUR END AS acknowledged_at) FROM ev""",
        ),
        (
            "alarms_marked",
            """SELECT power_plant_id, bool_or(NOT acknowledged) AS has_unacknowledged_alarm FROM (
            SELECT DISTINCT ON (power_plant_id, device_id, code) * FROM ev_marked ORDER BY power_plant_id, device_id, code, timestamp DESC)
            WHERE type = 'alarm' AND severity = 'high' GROUP BY 1""",
        ),
        (
            "operating_status",
            """SELECT p.id AS power_plant_id, CASE WHEN h.last_communication IS NULL THEN 'no_communication'
                WHEN a.has_unacknowledged_alarm THEN 'critical' WHEN a.has_high_alarm THEN 'acknowledged' ELSE 'generating' END AS power_plant_status
            FROM tb_power_plants p LEFT JOIN alarms a ON a.power_plant_id = p.id LEFT JOIN heard h ON h.power_plant_id = p.id
            WHERE p.is_active""",
        ),
        (
            "active_power",
            "SELECT power_plant_id, CAST(sum(value_numeric) AS DECIMAL(28,2)) AS active_power_kw FROM inv_long WHERE field_name = 'Active Power' GROUP BY 1",
        ),
        (
            "device_days",
            """SELECT CAST(time_bucket(INTERVAL 1 DAY, timestamp) AS DATE) AS date, power_plant_id, device_id, max(daily_active_energy) AS kwh
            FROM stg_inverter WHERE daily_active_energy IS NOT NULL GROUP BY 1, 2, 3""",
        ),
        (
            "plant_days",
            """SELECT date, power_plant_id, CAST(round(sum(kwh), 2) AS DECIMAL(28,2)) AS total_energy_kwh, count(device_id) AS total_active_inverters
            FROM device_days GROUP BY 1, 2""",
        ),
        (
            "portfolio_days",
            """SELECT date, CAST(round(sum(kwh), 2) AS DECIMAL(28,2)) AS total_energy_kwh, count(device_id) AS total_active_inverters,
            count(DISTINCT power_plant_id) AS total_power_plants FROM device_days GROUP BY 1""",
        ),
    ]
    return ctes


def _reports(parts: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS column_name, count(*) FILTER (WHERE {failed}) AS failures FROM {table}"
        for label, failed, table in parts
    )


_SHOWN = "timestamp, device_id, active_power, efficiency, temperature_internal"
_IRR_LATEST = _latest("stg_weather_station")


def _bodies() -> dict[str, str]:
    grid = " UNION ALL ".join(
        f"""SELECT timestamp, device_id, {_number(_text('active_power'), 'FLOAT')} AS as_float,
        {_number(_text('cumulative_active_energy'), 'DECIMAL2')} AS as_decimal, {_number(_text('state_simplified'), 'INTEGER')} AS as_integer,
        CAST({_number(_text('state_operation'), 'INTEGER')} AS BIGINT) AS as_bigint, {_number(_text('frequency'), 'FLOAT')} AS frequency,
        nullif(nullif(split_part({_text('active_power')}, '@', 1), ''), '-') AS as_text FROM raw_{kind}"""
        for kind in td.KINDS
    )
    heard = " UNION ALL ".join(
        f"SELECT power_plant_id, timestamp, '{kind}' AS device_type FROM stg_{kind} WHERE timestamp > {_WINDOW}"
        for kind in ("inverter", "logger", "meter", "relay", "weather_station")
    )
    half = "(SELECT as_of - INTERVAL 15 DAYS FROM clock)"
    local_half = "(SELECT local_now - INTERVAL 15 DAYS FROM clock)"
    since_days = "(SELECT CAST(as_of AS DATE) - INTERVAL 3 DAYS FROM clock)"
    bodies = {
        "grid_value_extract": grid,
        "grid_value_sql": grid,
        "code_counts_sql": """SELECT field, value, count(*) AS readings FROM (
            SELECT field, json_extract_string(json_data, '$."' || field || '"') AS value
            FROM (SELECT json_data, unnest(json_keys(json_data)) AS field FROM raw_relay))
            WHERE value IN ('0', '1', 'true', 'false') GROUP BY 1, 2""",
        **{f"stg_{name}_analog": f"SELECT * FROM stg_{kind}" for name, kind in _NAMES.items()},
        "stg_inverter_analog_corrected": "SELECT * FROM stg_inverter_month",
        "stg_weather_analog_corrected": "SELECT * FROM stg_weather_station_month",
        **{
            f"stg_{kind}_discrete": f"SELECT timestamp, power_plant_id, device_id, discrete_data_json FROM disc_{kind} WHERE discrete_data_json IS NOT NULL"
            for kind in ("inverter", "relay", "tracker")
        },
        "string_currents_latest": f"""SELECT timestamp, power_plant_id, device_id, device_name, CAST(n AS INTEGER) AS string_number, string_current, state_simplified FROM (
            SELECT {_LOCAL} AS timestamp, r.power_plant_id, r.device_id, d.device_name, n,
                   {_number("json_extract_string(json_data, '$.string_' || n || '_current')", 'DECIMAL2')} AS string_current,
                   {_number(_text('state_simplified'), 'INTEGER')} AS state_simplified
            FROM (SELECT DISTINCT ON (device_id) * FROM raw_inverter WHERE timestamp >= {_VALID_FROM} ORDER BY device_id, timestamp DESC) r
            CROSS JOIN range(1, 33) AS s(n) LEFT JOIN tb_devices d ON d.id = r.device_id) WHERE string_current IS NOT NULL""",
        "state_changes": "SELECT * FROM changes",
        "state_changes_incremental": f"SELECT * FROM changes WHERE timestamp > {local_half}",
        "last_known_states": """SELECT device_id, code, value AS last_value FROM (
            SELECT DISTINCT ON (device_id, code) * FROM changes ORDER BY device_id, code, timestamp DESC)""",
        "rejected_codes": """SELECT code, count(*) AS rejected FROM (
            SELECT code, json_extract_string(discrete_data_json, '$."' || code || '"') AS text FROM (
                SELECT discrete_data_json, unnest(json_keys(discrete_data_json)) AS code FROM (
                    SELECT discrete_data_json FROM disc_inverter UNION ALL SELECT discrete_data_json FROM disc_relay
                    UNION ALL SELECT discrete_data_json FROM disc_tracker)))
            WHERE text NOT IN ('0', '1', 'true', 'false') GROUP BY 1""",
        "events_enriched": "SELECT * FROM ev",
        "plant_status": f"""SELECT p.id AS power_plant_id,
            CASE WHEN a.power_plant_id IS NOT NULL THEN 'offline' WHEN h.n IS NULL THEN 'no_communication' ELSE 'generating' END AS power_plant_status,
            h.newest AS last_communication_timestamp, coalesce(h.n, 0) AS devices_communicating, a.power_plant_id IS NOT NULL AS has_critical_alarm,
            (SELECT as_of FROM clock) AS calculated_at
            FROM tb_power_plants p
            LEFT JOIN (SELECT power_plant_id, max(timestamp) AS newest, count(DISTINCT device_type) AS n FROM ({heard}) GROUP BY 1) h ON h.power_plant_id = p.id
            LEFT JOIN (SELECT DISTINCT power_plant_id FROM ev WHERE type = 'alarm' AND severity = 'high' AND timestamp > {_WINDOW}) a ON a.power_plant_id = p.id
            WHERE p.is_active""",
        "inverter_availability": "SELECT * FROM inverter_availability",
        "relay_availability": "SELECT * FROM relay_availability",
        "tracker_availability": "SELECT * FROM tracker_availability",
        "inverter_latest_long": "SELECT * FROM inv_long",
        "logger_latest": _latest("stg_logger", f"WHERE timestamp > {_LOOKBACK}"),
        "meter_latest": _latest("stg_meter"),
        "relay_latest": _latest("stg_relay"),
        "tracker_latest": _latest("stg_tracker"),
        "weather_latest": _IRR_LATEST,
        "latest_merged": _latest("stg_meter"),
        "daily_energy": "SELECT * FROM portfolio_days",
        "plant_daily_energy": "SELECT * FROM plant_days",
        "alarm_status": "SELECT * FROM alarms",
        "plant_comm_status": "SELECT * FROM heard",
        "operating_status": "SELECT * FROM operating_status",
        "events_acknowledged": "SELECT * FROM ev_marked",
        "operating_status_acknowledged": """SELECT p.id AS power_plant_id, CASE WHEN h.last_communication IS NULL THEN 'no_communication'
            WHEN a.has_unacknowledged_alarm THEN 'critical' WHEN a.power_plant_id IS NOT NULL THEN 'acknowledged' ELSE 'generating' END AS power_plant_status
            FROM tb_power_plants p LEFT JOIN alarms_marked a ON a.power_plant_id = p.id LEFT JOIN heard h ON h.power_plant_id = p.id
            WHERE p.is_active""",
        "device_staleness": f"""SELECT d.id AS device_id, d.power_plant_id, r.last_reading, CASE WHEN r.last_reading IS NULL THEN 'absent'
            WHEN r.last_reading > {_STALE} THEN 'fresh' ELSE 'stale' END AS state
            FROM tb_devices d JOIN tb_power_plants p ON p.id = d.power_plant_id AND p.is_active
            LEFT JOIN (SELECT device_id, max(timestamp) AS last_reading FROM stg_inverter WHERE timestamp > {_LOOKBACK} GROUP BY 1) r ON r.device_id = d.id
            WHERE d.is_active AND d.device_type_id = {DEVICE_TYPES['inverter']}""",
        "active_power_by_plant": "SELECT * FROM active_power",
        "plant_energy_now": _energy_now("stg_inverter"),
        "daily_irradiation": _irradiation("stg_weather_station"),
        "performance_ratio": _performance("stg_inverter", "stg_weather_station"),
        "plants_overview": _overview(
            "stg_inverter", "stg_weather_station", f"({_IRR_LATEST})", "CAST(coalesce(et.et_kwh, 0) AS DECIMAL(18,2))"
        ),
        "plants_overview_corrected": _overview(
            "stg_inverter_month", "stg_weather_station_month", f"({_IRR_LATEST})", "CAST(NULL AS DECIMAL(18,2))"
        ),
        "incremental_append": f"""{_stage('relay', f'(SELECT * FROM raw_relay WHERE timestamp <= {half})')}
            UNION ALL {_stage('relay', f'(SELECT * FROM raw_relay WHERE timestamp > {half})')}""",
        "incremental_append_tz": f"""WITH first AS ({_stage('inverter', f'(SELECT * FROM raw_inverter WHERE timestamp <= {half})')})
            SELECT * FROM first UNION ALL {_stage('inverter', '(SELECT * FROM raw_inverter WHERE timestamp > (SELECT max(timestamp) + INTERVAL 3 HOURS FROM first))')}""",
        "delete_insert_days": f"""SELECT * FROM portfolio_days""",
        "delete_insert_plant_days": "SELECT * FROM plant_days",
        "energy_window": f"SELECT * FROM portfolio_days WHERE date >= {since_days}",
        "keyed_upsert": "SELECT * FROM stg_meter",
        "event_upsert": "SELECT * FROM ev",
        "synced_columns": f"""SELECT * EXCLUDE (line_voltage_ca, arrived), CASE WHEN arrived > {half} THEN active_power / 2 END AS half_power FROM (
            {_stage('relay', 'raw_relay').replace('* EXCLUDE (arrived)', '*')})""",
        "retention_filter": f"SELECT * FROM stg_inverter WHERE timestamp >= (SELECT local_now - {_interval(td.HORIZON)} FROM clock)",
        "month_to_date": f"SELECT timestamp, power_plant_id, device_id, json_data FROM raw_weather_station WHERE timestamp >= date_trunc('month', {_SECOND})",
        "horizon_filter": f"SELECT timestamp, power_plant_id, device_id FROM raw_weather_station WHERE timestamp >= {_SECOND} - {_interval(td.HORIZON)}",
        "not_null_report": _reports([(c, f"{c} IS NULL", "stg_inverter") for c in _REPORTED]),
        "unique_report": """SELECT 'id' AS column_name, count(*) AS failures FROM (SELECT id FROM ev GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'device_id, timestamp', count(*) FROM (SELECT device_id, timestamp FROM ev GROUP BY 1, 2 HAVING count(*) > 1)""",
        "accepted_range_report": _reports(
            [("frequency", "frequency NOT BETWEEN 60.04 AND 61.0", "stg_inverter"), ("efficiency", "efficiency NOT BETWEEN 0 AND 100", "stg_inverter"),
             ("temperature_internal", "temperature_internal NOT BETWEEN -10 AND 100", "stg_inverter")]
        ),
        "accepted_values_report": _reports(
            [("state_operation", "state_operation NOT IN (0, 1, 2, 3, 4, 5)", "stg_inverter"), ("state_simplified", "state_simplified NOT IN (0, 1, 2)", "stg_inverter")]
        ),
        "relationships_report": """SELECT 'device_id' AS column_name, count(*) AS failures, count(DISTINCT device_id) AS missing_parents
            FROM stg_inverter WHERE device_id NOT IN (SELECT id FROM tb_devices WHERE is_active)""",
        "source_checks": " UNION ALL ".join(
            [
                f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {name}"
                for table, name, columns in (
                    *((f"raw_{kind}", f"raw_{kind}", ("timestamp", "power_plant_id", "device_id", "json_data")) for kind in td.KINDS),
                    ("tb_power_plants", "tb_power_plants", ("id", "customer_id", "name")),
                    ("tb_devices", "tb_devices", ("id", "device_type_id", "power_plant_id")),
                    ("tb_event_alarm_catalog", "catalog", ("device_type_id", "code", "value", "description", "type", "severity", "is_active")),
                )
                for c in columns
            ]
            + ["SELECT 'tb_event_alarm_catalog', 'not_null', 'id', 0"]
            + [
                f"SELECT '{table}', 'unique', 'id', count(*) FROM (SELECT id FROM {table} GROUP BY 1 HAVING count(*) > 1)"
                for table in ("tb_power_plants", "tb_devices")
            ]
        ),
        "freshness_report": " UNION ALL ".join(
            f"""SELECT 'raw_{kind}' AS source_name, max(timestamp) AS newest, CASE
            WHEN max(timestamp) < (SELECT as_of - INTERVAL 30 MINUTES FROM clock) THEN 'error'
            WHEN max(timestamp) < (SELECT as_of - INTERVAL 10 MINUTES FROM clock) THEN 'warn' ELSE 'pass' END AS status FROM raw_{kind}"""
            for kind in td.KINDS
        ),
        "duplicate_audit": f"""SELECT copies, count(*) AS keys, copies * count(*) AS rows FROM (
            SELECT device_id, {_LOCAL} AS t, count(*) AS copies FROM raw_inverter GROUP BY 1, 2) GROUP BY 1""",
        "device_last_24h": f"SELECT {_SHOWN} FROM stg_inverter WHERE device_id = 1 AND timestamp >= (SELECT local_now - {_interval(td.LOOKBACK)} FROM clock)",
        "newest_readings": f"SELECT {_SHOWN} FROM stg_inverter ORDER BY timestamp DESC, device_id LIMIT 10",
        "last_processed": "SELECT max(timestamp) AS last_processed FROM stg_inverter",
        "daily_counts": """SELECT CAST(timestamp AS DATE) AS day, count(*) AS records, count(DISTINCT device_id) AS devices FROM stg_inverter
            GROUP BY 1 ORDER BY 1 DESC LIMIT 7""",
    }
    return bodies


_NAMES = {
    "inverter": "inverter",
    "relay": "relay",
    "logger": "logger",
    "meter": "meter",
    "weather": "weather_station",
    "tracker": "tracker",
}
_REPORTED = ("timestamp", "power_plant_id", "device_id", "active_power", "frequency", "power_factor", "state_operation")


def oracle_sql() -> dict[str, str]:
    prefix = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _fixture())
    return {name: f"{prefix}\nSELECT * FROM (\n{body}\n) AS result" for name, body in _bodies().items()}
