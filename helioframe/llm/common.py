"""Helpers the operators share: the shared folder, written tables, whole texts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only a local session that names none gets a temporary one, as in tests.
    """
    named = spark.conf.get(CHECKPOINT_DIR, "") or spark.sparkContext.getConf().get(CHECKPOINT_DIR, "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here and lost executors cost nothing.

    The folder goes with ``discard``, at the latest when the session ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole_text(column: str = "text") -> Column:
    """The text as a string; a null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def numbered_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id (a long, null stays null) and the whole text, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))


def place_of(docs: DataFrame, name: str) -> int:
    """The place of a column: the one of just this name, else the one that differs in case alone."""
    exact = [i for i, c in enumerate(docs.columns) if c == name]
    return (exact or [i for i, c in enumerate(docs.columns) if c.lower() == name.lower()])[0]


def free_name(docs: DataFrame, name: str) -> str:
    """The name, made longer until no column of the table has it, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_row(left: Column, right: Column) -> Column:
    """Equal, or both null."""
    return left.eqNullSafe(right)


DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
