"""Tagged telemetry values such as ``"60.07@2025-12-11T13:50:14Z"`` or a plain ``60.07``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from helioframe.specs import DECIMAL2, FLOAT, INTEGER

PAYLOAD_MAP = "map<string,string>"
_EXACT = "decimal(38,18)"
_NUMERIC2 = "decimal(18,2)"

# SQL names of the whole-number targets and the Spark type of each.
WHOLE_NUMBER_TYPES = {
    "INTEGER": "int",
    "INT": "int",
    "INT4": "int",
    "BIGINT": "bigint",
    "INT8": "bigint",
    "SMALLINT": "smallint",
    "INT2": "smallint",
}


def payload_struct(json_data: Column, fields: Iterable[str]) -> Column:
    """One parse of the payload that keeps only the named fields, all as text.

    A field that occurs twice keeps its last value, and text that is not an object gives NULLs.
    """
    return F.from_json(json_data, "struct<" + ",".join(f"`{name}`:string" for name in fields) + ">")


def payload_map(json_data: Column) -> Column:
    """One parse of the payload that keeps every field, all as text."""
    return F.from_json(json_data, PAYLOAD_MAP)


def payload_typed(json_data: Column) -> Column:
    """One parse of the payload that keeps every field with its JSON type."""
    return F.from_json(json_data, "map<string,variant>")


def typed_text(value: Column) -> Column:
    """The text of a typed field; NULL for an object or a list."""
    return F.try_variant_get(value, "$", "string")


def grid_value_sql(value: str, cast_as: str = FLOAT) -> str:
    """SQL that converts the text of one payload field; unreadable text gives NULL.

    ``value`` is itself SQL, such as a column name. Working in SQL text keeps a wide projection at one
    call from Python instead of several per field.
    """
    kind = cast_as.upper()
    head = f"substring_index({value}, '@', 1)"
    if kind in ("TEXT", "VARCHAR"):
        return f"nullif(nullif({head}, ''), '-')"
    # Empty text and a dash need no test below: try_cast gives NULL for them already.
    if kind in WHOLE_NUMBER_TYPES:
        # "512.0" is fine and fractions round, halves away from zero.
        return f"try_cast(round(try_cast({head} AS {_EXACT}), 0) AS {WHOLE_NUMBER_TYPES[kind]})"
    if kind == DECIMAL2:
        return f"try_cast(round(try_cast({head} AS {_EXACT}), 2) AS {_NUMERIC2})"
    if kind in ("NUMERIC", "DECIMAL"):
        return f"try_cast({head} AS {_EXACT})"
    if kind in (FLOAT, "DOUBLE PRECISION", "FLOAT8"):
        # Spark reads a trailing d or f as a Java number suffix; spoil those letters, "1d" is no number.
        return f"try_cast(translate({head}, 'dDfF', 'xxxx') AS DOUBLE)"
    raise ValueError(f"no conversion to {cast_as}")


def grid_value(value: str, cast_as: str = FLOAT) -> Column:
    return F.expr(grid_value_sql(value, cast_as))


def extract_grid_value(json_data: str, field: str, cast_as: str = FLOAT) -> Column:
    """One field straight from the payload text; for several fields parse once with payload_struct."""
    return grid_value(f"from_json({json_data}, 'struct<`{field}`:string>').`{field}`", cast_as)


__all__ = [
    "DECIMAL2",
    "FLOAT",
    "INTEGER",
    "extract_grid_value",
    "grid_value",
    "grid_value_sql",
    "payload_map",
    "payload_struct",
    "payload_typed",
    "typed_text",
]
