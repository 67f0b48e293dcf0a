"""Paths on any file system the cluster reaches, and frames written once to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from helioframe.session import shared_dir


def opened(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def delete_path(spark: SparkSession, path: str) -> bool:
    files, folder = opened(spark, path)
    return files.delete(folder, True)


def temporary(spark: SparkSession, path: str) -> str:
    """The path, made as a folder that goes when the session ends."""
    files, folder = opened(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def child_folders(spark: SparkSession, path: str) -> list[str]:
    files, folder = opened(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    files, folder = opened(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder) if not status.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    files, file = opened(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A new file, whole or not at all; refuses a path that is taken.

    The text goes to a file of another name, which is then renamed without overwriting.
    """
    draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
    files, source = opened(spark, draft)
    stream = files.create(source)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    target = context.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(source), target, none)
    except Exception:
        files.delete(source, False)
        raise


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame as a table written to the cluster's shared folder, so that it is computed once."""
    path = temporary(spark, f"{shared_dir(spark)}/batch-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a materialized frame."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/batch-" in path:
            delete_path(spark, path)
