"""Watermarks, horizons and keyed merges over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import PLANT_ZONE, Clock, between, interval, naive_timestamp, zone_to_instant


def watermark_of(target: DataFrame, column: str = "timestamp") -> datetime | None:
    """Newest stored time, read to the driver as one value so that it can prune files as a literal."""
    # A naive column reads back as it stands; an instant is first written out in UTC.
    return target.agg(F.max(F.col(column).cast("timestamp_ntz"))).first()[0]


def incremental_filter(
    source: DataFrame,
    watermark: datetime | None,
    *,
    column: str = "timestamp",
    allowed_lateness: str | None = None,
) -> DataFrame:
    """Rows above the watermark; everything when there is none yet.

    With ``allowed_lateness`` rows that far below it are read again, for a keyed write to absorb.
    """
    if watermark is None:
        return source
    bound = naive_timestamp(watermark)
    if allowed_lateness:
        bound = bound - interval(allowed_lateness)
    return between(source, bound.cast(source.schema[column].dataType), column=column)


def incremental_filter_local(source: DataFrame, local_watermark: datetime | None, zone: str = PLANT_ZONE) -> DataFrame:
    """Raw rows above a watermark that was stored in plant-local time.

    The naive time is turned back into the instant it names before it meets the raw clock.
    """
    if local_watermark is None:
        return source
    return source.filter(F.col("timestamp") > zone_to_instant(naive_timestamp(local_watermark), zone))


def within_horizon(df: DataFrame, clock: Clock, horizon: str, column: str = "timestamp") -> DataFrame:
    """Rows at most ``horizon`` older than the clock, on either of the two clocks."""
    instant = df.schema[column].dataType.simpleString() == "timestamp"
    moment = clock.instant() if instant else clock.local()
    return between(df, moment - interval(horizon), column=column, closed_lower=True)


def month_to_date(raw: DataFrame, clock: Clock) -> DataFrame:
    """Raw rows since the first of the clock's month, in UTC."""
    return between(raw, F.date_trunc("month", clock.instant()), closed_lower=True)


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the batch put in: a key found in the batch replaces every target row of that key."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def rows_not_in(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not hold yet."""
    return batch.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)


def retain(df: DataFrame, clock: Clock, horizon: str, column: str = "timestamp") -> DataFrame:
    """Drop rows older than the retention horizon."""
    return within_horizon(df, clock, horizon, column)


def check_schema(batch: DataFrame, target: DataFrame) -> None:
    """Refuse a batch whose columns or types differ from the target's."""
    found = {f.name: f.dataType.simpleString() for f in batch.schema}
    expected = {f.name: f.dataType.simpleString() for f in target.schema}
    if found != expected:
        drift = sorted(set(found.items()) ^ set(expected.items()))
        raise ValueError(f"schema drift: {drift}")


def sync_columns(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows in the batch's columns: new ones come as NULL, removed ones go."""

    def column(field) -> Column:
        if field.name in stored.columns:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return stored.select(*(column(field) for field in batch.schema))
