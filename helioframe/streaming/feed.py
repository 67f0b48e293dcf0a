"""A raw stream into the stored warehouse, one micro-batch at a time.

Each micro-batch goes through the same steps as an incremental run: newest arrival per reading, keyed
upsert, and all derived tables up to the plant overview. Every step may be repeated, so a micro-batch
that Spark delivers again after a failure leaves the tables as they were.

Change detection is not done with per-key state functions: those hand all rows of one device and code
to one Python call, while the batch operator spreads a busy code over its hours.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helioframe.functions.clock import Clock
from helioframe.operators.incremental import watermark_of
from helioframe.plans.warehouse import Warehouse
from helioframe.sources import sinks


def tagged_union(raw_by_kind: Mapping[str, DataFrame]) -> DataFrame:
    """Raw streams of several device types as one, so that one query owns the tables."""
    tagged = (raw.withColumn("kind", F.lit(kind)) for kind, raw in raw_by_kind.items())
    return reduce(DataFrame.unionByName, tagged)


def absorb_batch(warehouse: Warehouse, batch: DataFrame) -> None:
    """Put one micro-batch of tagged raw rows into the warehouse."""
    ready = sinks.materialize(batch.sparkSession, batch)
    try:
        _absorb(warehouse, ready)
    finally:
        sinks.discard(batch.sparkSession, ready)


def _absorb(warehouse: Warehouse, ready: DataFrame) -> None:
    newest = watermark_of(ready)
    if newest is not None:
        # A micro-batch of old arrivals does not turn the time back.
        before = warehouse.positions.read("feed")
        clock = Clock(newest if before is None else max(before, newest))
        kinds = sorted(row[0] for row in ready.select("kind").distinct().collect())  # a few device types
        days = {
            kind: warehouse.absorb(kind, ready.filter(F.col("kind") == kind).drop("kind"), clock) for kind in kinds
        }
        warehouse.refresh_derived(clock, days=days.get("inverter", ()))
        warehouse.positions.write("feed", clock.as_of)
        warehouse.commit()


def start_feed(
    warehouse: Warehouse, raw_by_kind: Mapping[str, DataFrame], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start feeding; without ``every`` the query takes what is there and stops (a backfill)."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        absorb_batch(warehouse, batch)

    writer = tagged_union(raw_by_kind).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def upsert_each_batch(path: str, keys: list[str], partition: str = "date"):
    """A foreachBatch function that keeps a stored table up to date from an update-mode stream."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        rows = sinks.with_day(batch) if partition == "date" else batch
        sinks.upsert(batch.sparkSession, rows, path, keys, partition=partition)

    return handle
