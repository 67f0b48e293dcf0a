"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, token ids.

Each stage reads what the one before it has written as Parquet. All but the last return the columns of
``documents``; a column that clashes with a helper column is never touched, because helpers get names of
their own. An empty table goes through every stage and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.llm import decontaminate, lines, neardup, pieces, toxicity
from helioframe.llm.common import free_name, written
from helioframe.llm.queries import benchmark_items, piece_model, toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; null and empty texts stay."""
    return toxicity.reject_toxic(docs, toxicity_model(spark, docs, sf_dir))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that spread over many sources; n_chars follows the text.

    A spread line stays in the document with the least id; null texts stay null and rows of null ids lose it too
    (where every holder's id is null, all keep it). Repeated rows are cleaned alike.
    """
    cleaned = lines.clean(docs, removed=free_name(docs, "__removed"))
    columns = [F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cleaned.select(*columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class, null ids last; of equal ids that of the least text digest.

    Rows equal in id and text are one document. Null and empty texts are one class.
    """
    return neardup.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts stay, repeated rows fare alike, null items match nothing."""
    return decontaminate.reject_contaminated(docs, benchmark_items(spark, sf_dir))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of its text with the end id, and their number; a null or empty text has the end id only."""
    return pieces.encode(docs, piece_model()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", pieces_stage),
]

#: Learnt weights, random-walk embeddings and token merges are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
