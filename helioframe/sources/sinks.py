"""Writing tables: full refresh, append, replace by partition, keyed upsert, compaction, retention.

Day-partitioned tables have a ``date`` column that follows from the key of their rows. Partitions are
replaced with Spark's dynamic partition overwrite, which stages the new files first and removes the
old ones when the job commits, so a task that is retried after a lost executor still finds its input.
A driver that dies inside that commit can lose a day: the warehouse keeps its tables in
``helioframe.sources.versioned``, and the functions here serve plain folders other programs read, such as exports
and the sinks of a stream. Compaction, retention and reading take either kind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.clock import DAY, Clock, interval
from helioframe.operators.incremental import check_schema, merge_by_key, sync_columns
from helioframe.sources.files import child_folders, delete_path, discard, materialize
from helioframe.sources.tables import read_table, table_exists
from helioframe.sources.versioned import Table, changed_rows
from helioframe.specs import COMPACT_AFTER, RETENTION


def with_day(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df if DAY in df.columns else df.withColumn(DAY, F.to_date(column))


def partition_values(spark: SparkSession, path: str, partition: str = DAY) -> list[str]:
    """Values of the partition folders of a stored table."""
    if Table.is_at(spark, path):
        return Table(spark, path).partitions()
    return sorted(name.split("=", 1)[1] for name in child_folders(spark, path) if name.startswith(f"{partition}="))


def _clustered(df: DataFrame, partition: str) -> DataFrame:
    """Rows gathered by partition, newest first per device.

    REBALANCE cuts a large day into several files of the advisory size and merges small ones; a plain
    repartition by day would put a whole day into one task.
    """
    order: list[Column] = [F.col(partition)]
    if "device_id" in df.columns:
        order.append(F.col("device_id"))
    if "timestamp" in df.columns:
        order.append(F.desc("timestamp"))
    return df.hint("rebalance", partition).sortWithinPartitions(*order)


def _write(df: DataFrame, path: str, partition: str, mode: str) -> None:
    writer = _clustered(df, partition).write.mode(mode).partitionBy(partition)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def create_partitioned(df: DataFrame, path: str, partition: str = DAY) -> None:
    """Full refresh of a partitioned table."""
    writer = _clustered(df, partition).write.mode("overwrite").partitionBy(partition)
    writer.option("partitionOverwriteMode", "static").parquet(path)


def refresh(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Full refresh of a small table that may itself be among the inputs."""
    ready = materialize(spark, df)
    try:
        ready.write.mode("overwrite").parquet(path)
    finally:
        discard(spark, ready)


def create_view(df: DataFrame, name: str) -> None:
    """A view that is computed anew whenever it is read."""
    df.createOrReplaceTempView(name)


def append(spark: SparkSession, batch: DataFrame, path: str, partition: str = DAY) -> None:
    """Add rows; a batch whose columns differ from the table's is refused."""
    if table_exists(spark, path):
        check_schema(batch, read_table(spark, path))
    _write(batch, path, partition, "append")


def replace_partitions(
    spark: SparkSession, batch: DataFrame, path: str, partition: str = DAY, check: bool = True
) -> None:
    """Replace every partition that occurs in the batch and leave the others alone."""
    if check and table_exists(spark, path):
        check_schema(batch, read_table(spark, path))
    _write(batch, path, partition, "overwrite")


def _values(df: DataFrame, partition: str) -> list:
    # Partition values only: one per day (or shard) of the batch, whatever the number of rows.
    return [row[0] for row in df.select(partition).distinct().collect()]


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    partition: str = DAY,
    on_schema_change: str = "fail",
    on_change: Callable[[DataFrame], None] | None = None,
) -> list:
    """Put a batch with unique keys into a partitioned table; its rows replace rows of the same key.

    Rows that are stored already in the same form are left out first, so a batch that is delivered again
    writes nothing. New keys are appended, and a partition is rewritten only where a key comes with other
    values. ``on_change`` is given the rows that will be written, before they are. Returns the partition
    values the batch names.
    """
    if not table_exists(spark, path):
        if on_change:
            on_change(batch)
        create_partitioned(batch, path, partition)
        # A batch without rows leaves no files, and so no table yet.
        return _values(read_table(spark, path), partition) if table_exists(spark, path) else []
    stored = read_table(spark, path)
    if on_schema_change == "sync" and set(stored.columns) != set(batch.columns):
        _write(sync_columns(stored, batch), path, partition, "overwrite")
        stored = read_table(spark, path)
    check_schema(batch, stored)

    columns, match = batch.columns, list(dict.fromkeys([*keys, partition]))
    ready = materialize(spark, batch)
    changed = None
    try:
        values = _values(ready, partition)
        named = stored.filter(F.col(partition).isin(values))
        changed = materialize(spark, changed_rows(ready, named.select(*columns), match))
        if on_change:
            on_change(changed)
        clashing = _values(named.select(*match).join(changed.select(*match), match, "left_semi"), partition)
        fresh = changed
        if clashing:
            inside = F.col(partition).isin(clashing)
            merged = merge_by_key(named.filter(inside), changed.filter(inside), keys).select(*columns)
            _write(merged, path, partition, "overwrite")
            fresh = changed.filter(~inside)
        _write(fresh, path, partition, "append")
    finally:
        discard(spark, ready)
        if changed is not None:
            discard(spark, changed)
    return values


def compact(
    spark: SparkSession, path: str, clock: Clock, after: str = COMPACT_AFTER, days: int = 1, partition: str = DAY
) -> list[str]:
    """Rewrite the days that have just become older than ``after`` into few clustered files.

    A daily job needs ``days=1``; a larger number catches up. Older days are left as they are.
    """
    row = spark.range(1).select(F.to_date(clock.local() - interval(after)).alias("end")).first()
    end = row["end"]
    due = [
        value
        for value in partition_values(spark, path, partition)
        if 0 < (end - _date(value)).days <= days
    ]
    if due and Table.is_at(spark, path):
        Table(spark, path).compact(due)
    elif due:
        old = read_table(spark, path).filter(F.col(partition).isin([_date(value) for value in due]))
        _write(old, path, partition, "overwrite")
    return due


def drop_expired(
    spark: SparkSession, path: str, clock: Clock, horizon: str = RETENTION, partition: str = DAY
) -> list[str]:
    """Remove whole days older than the horizon, without reading them."""
    row = spark.range(1).select(F.to_date(clock.local() - interval(horizon)).alias("first")).first()
    expired = [value for value in partition_values(spark, path, partition) if _date(value) < row["first"]]
    drop_partitions(spark, path, expired, partition)
    return expired


def drop_partitions(spark: SparkSession, path: str, values: Sequence[str], partition: str = DAY) -> None:
    if Table.is_at(spark, path):
        return Table(spark, path).drop_partitions(values)
    for value in values:
        delete_path(spark, f"{path}/{partition}={value}")


def _date(value: str) -> date:
    return date.fromisoformat(value)
