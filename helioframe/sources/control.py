"""How far each load has come, kept beside the tables.

The position of a raw load is an arrival time, while staged rows carry only payload times, so it
cannot be read back from the staged table itself.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from helioframe.functions.clock import naive_timestamp
from helioframe.sources.versioned import Table


class Positions:
    """One row per finished load; the newest position of a name counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self, name: str) -> datetime | None:
        table = Table(self.spark, self.path, None)
        if not table.exists():
            return None
        rows = table.read().filter(F.col("name") == name)
        # The newest record counts, not the highest position: a full refresh may go back.
        newest = rows.agg(F.max_by("position", "recorded_at")).first()
        return newest[0]

    def write(self, name: str, position: datetime) -> None:
        row = self.spark.range(1).select(
            F.lit(name).alias("name"),
            naive_timestamp(position).alias("position"),
            F.current_timestamp().alias("recorded_at"),
        )
        Table(self.spark, self.path, None).append(row)

    def compact(self) -> None:
        """Keep only the newest record of each name."""
        table = Table(self.spark, self.path, None)
        if table.exists():
            newest = F.max_by("position", "recorded_at").alias("position")
            table.create(table.read().groupBy("name").agg(newest, F.max("recorded_at").alias("recorded_at")))
