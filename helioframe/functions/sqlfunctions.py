"""The grid-value extraction as functions of the SQL catalog, for users who write SQL.

A SQL function has one result type, so there is one function for each target; all are SQL themselves, so Spark puts
their bodies into the query's plan and no Python runs. ``register`` makes them temporary functions of the session, or
permanent ones in a schema of the catalog. Spark 4.1 cannot plan several such calls above a UNION; call them in each
part of it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from helioframe.functions.gridvalue import PAYLOAD_MAP, grid_value_sql
from helioframe.specs import DECIMAL2, FLOAT, INTEGER

#: Function, target and SQL type of each form.
TARGETS = (
    ("extract_grid_value", FLOAT, "DOUBLE"),
    ("extract_grid_decimal", DECIMAL2, "DECIMAL(18,2)"),
    ("extract_grid_numeric", "NUMERIC", "DECIMAL(38,18)"),
    ("extract_grid_integer", INTEGER, "INT"),
    ("extract_grid_bigint", "BIGINT", "BIGINT"),
    ("extract_grid_smallint", "SMALLINT", "SMALLINT"),
    ("extract_grid_text", "TEXT", "STRING"),
)
PAIRS = "grid_value_pairs"


def register(spark: SparkSession, schema: str | None = None) -> list[str]:
    """Make the functions known and give their names; ``schema`` stores them in the catalog for all sessions.

    ``extract_grid_value(json_data, field)`` gives one field of a payload, unreadable text gives NULL;
    ``grid_value_pairs(json_data)`` is a table function with a row (field, value) for every field.
    """
    kind, prefix = ("TEMPORARY FUNCTION", "") if schema is None else ("FUNCTION", f"{schema}.")
    text = f"from_json(json_data, '{PAYLOAD_MAP}')[field]"
    for name, target, returned in TARGETS:
        body = grid_value_sql(text, target)
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{name}(json_data STRING, field STRING) RETURNS {returned} RETURN {body}")
    rows = f"SELECT pair.key, pair.value FROM (SELECT explode(map_entries(from_json(json_data, '{PAYLOAD_MAP}'))) AS pair)"
    spark.sql(f"CREATE OR REPLACE {kind} {prefix}{PAIRS}(json_data STRING) RETURNS TABLE (field STRING, value STRING) RETURN {rows}")
    return [f"{prefix}{name}" for name, _, _ in TARGETS] + [f"{prefix}{PAIRS}"]
