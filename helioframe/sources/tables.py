"""Reading raw telemetry and the reference tables, and the stored tables of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helioframe.schemas import RAW
from helioframe.session import ensure_utc
from helioframe.sources.versioned import Table


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A raw telemetry table in any format Spark reads, with the declared columns.

    ``json_data`` may hold text or, in JSON files, an object; both come out as text.
    """
    reader = ensure_utc(spark).read.format(fmt).options(**options)
    if fmt in ("json", "csv"):
        reader = reader.schema(RAW)
    return _as_raw(reader.load(path) if path else reader.load())


def read_raw_jdbc(spark: SparkSession, url: str, table: str, days: list[str], **options: str) -> DataFrame:
    """A raw table in a database, read in parallel with one query per arrival day.

    ``days`` are ISO dates in UTC; the last one is open-ended.
    """
    bounds = [f"timestamp >= '{start}' AND timestamp < '{end}'" for start, end in zip(days, days[1:])]
    bounds.append(f"timestamp >= '{days[-1]}'")
    frame = ensure_utc(spark).read.jdbc(url, table, predicates=bounds, properties=options)
    return _as_raw(frame)


def _as_raw(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(field.name).cast(field.dataType).alias(field.name) for field in RAW))


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """New raw files as a stream; ``maxFilesPerTrigger`` bounds a micro-batch."""
    return ensure_utc(spark).readStream.format(fmt).schema(RAW).options(**options).load(path)


def read_reference(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """One of the reference tables, in its declared types."""
    reader = ensure_utc(spark).read.format(fmt)
    if fmt in ("json", "csv"):
        return reader.schema(schema).load(path)
    stored = reader.load(path)
    return stored.select(
        *(
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in stored.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table of either kind; day-partitioned ones have their ``date`` column."""
    return Table(spark, path).read() if Table.is_at(spark, path) else spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table with data files is there, on any file system the cluster can reach."""
    if Table.is_at(spark, path):
        return bool(Table(spark, path).leaves())
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return any(not name.startswith(("_", ".")) for name in names)
