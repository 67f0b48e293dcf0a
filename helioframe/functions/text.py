"""Text helpers for labels and event ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2_sql(value: str) -> str:
    """Two decimal places, halves away from zero, as SQL over SQL; NULL for a number that does not fit."""
    return f"try_cast(round(try_cast({value} AS decimal(38,18)), 2) AS decimal(18,2))"


def round2(value: Column) -> Column:
    """Two decimal places, halves away from zero; NULL for a number that does not fit."""
    return F.round(value.try_cast("decimal(38,18)"), 2).try_cast("decimal(18,2)")


def signed_hash64(text: Column) -> Column:
    """The first 64 bits of the MD5 of a text, as a signed number."""
    return F.conv(F.left(F.md5(text), F.lit(16)), 16, -10).cast("bigint")


def event_id(device_id: Column, moment: Column, code: Column) -> Column:
    """Stable id of one event; the parts are joined without separators."""
    return F.abs(signed_hash64(F.concat(device_id.cast("string"), moment.cast("string"), code)))
