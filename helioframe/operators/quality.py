"""Data-quality checks: each gives a small report, computed in one pass where possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.clock import Clock, interval
from helioframe.specs import DECLARED_CHECKS, FRESHNESS_ERROR, FRESHNESS_WARN, TABLE_KEYS


def _failures(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows failing each named condition, all counted in the same scan."""
    names = list(checks)
    counted = df.agg(*(F.count_if(checks[name]).alias(f"c{i}") for i, name in enumerate(names)))
    rows = F.array(
        *(F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("failures")) for i, name in enumerate(names))
    )
    return counted.select(F.inline(rows))


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _failures(df, {name: F.col(name).isNull() for name in columns})


def accepted_range_report(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside their range; NULL passes, not_null_report looks at those."""
    return _failures(df, {name: ~F.col(name).between(low, high) for name, (low, high) in ranges.items()})


def accepted_values_report(df: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    return _failures(df, {name: ~F.col(name).isin(*allowed) for name, allowed in values.items()})


def unique_report(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Key values that occur more than once; a key may span several columns."""
    reports = []
    for key in keys:
        repeated = df.dropna(subset=list(key)).groupBy(*key).count().filter("count > 1")
        reports.append(
            repeated.agg(F.count("*").alias("failures")).select(F.lit(", ".join(key)).alias("column_name"), "failures")
        )
    return reduce(DataFrame.unionByName, reports)


def declared_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared checks of each table given: one scan for its NULLs, one aggregation per unique key."""
    reports = []
    for table, df in tables.items():
        required, unique = DECLARED_CHECKS.get(table, ((), ()))
        found = []
        if required:
            found.append(not_null_report(df, required).withColumn("check_name", F.lit("not_null")))
        keys = [(column,) for column in unique]
        if table in TABLE_KEYS and TABLE_KEYS[table] not in keys:
            keys.append(TABLE_KEYS[table])
        if keys:
            found.append(unique_report(df, keys).withColumn("check_name", F.lit("unique")))
        reports += [report.withColumn("table_name", F.lit(table)) for report in found]
    return reduce(DataFrame.unionByName, reports).select("table_name", "check_name", "column_name", "failures")


def relationships_report(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference finds no parent.

    Child rows are counted per value first, so the join meets each value once however often it occurs.
    """
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = per_value.join(known, column, "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"), F.count("*").alias("missing_parents")
    ).select(F.lit(column).alias("column_name"), "failures", "missing_parents")


def freshness_report(
    sources: Mapping[str, DataFrame],
    clock: Clock,
    *,
    column: str = "timestamp",
    warn_after: str = FRESHNESS_WARN,
    error_after: str = FRESHNESS_ERROR,
) -> DataFrame:
    """How old the newest row of each source is, as pass, warn or error."""

    def newest(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.max(column).alias("newest")).select(F.lit(name).alias("source_name"), "newest")

    rows = reduce(DataFrame.unionByName, (newest(name, df) for name, df in sources.items()))
    now = clock.instant()
    return rows.select(
        "source_name",
        "newest",
        F.when(F.col("newest").isNull() | (F.col("newest") < now - interval(error_after)), "error")
        .when(F.col("newest") < now - interval(warn_after), "warn")
        .otherwise("pass")
        .alias("status"),
    )


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur once, twice, three times and so on."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return copies.groupBy("copies").agg(F.count("*").alias("keys")).withColumn("rows", F.col("copies") * F.col("keys"))
