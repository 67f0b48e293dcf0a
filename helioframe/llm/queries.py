"""The registered queries of the training-data operators: thin calls over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.llm import (
    decontaminate,
    fingerprint,
    language,
    lines,
    neardup,
    pieces,
    pseudonyms,
    ranked,
    runs,
    secrets,
    tokenfile,
    toxicity,
    urlfilter,
)
from helioframe.llm.common import free_name, new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _count(findings: str, kind: int | str) -> Column:
    """How many findings of an array are of the kind."""
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")


def learnt_from(doc_id: str = "doc_id"):
    """Whether labels of a document may be learnt: its checksum is not in the held-out third."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1


def toxicity_model(spark: SparkSession, docs: DataFrame, folder: str) -> toxicity.Model:
    labels = _table(spark, folder, "labels").filter(learnt_from())
    return toxicity.train(toxicity.training_sample(docs, labels))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, docs, folder))
    return scored.select(
        "doc_id",
        F.coalesce(~learnt_from(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = secrets.find_secrets(docs, secrets.train(secrets.labelled_samples(docs)))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = [_count("spans", k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)]
    return found.select(
        "doc_id",
        *count[:3],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        count[3],
    )


def benchmark_items(spark: SparkSession, folder: str) -> decontaminate.ItemBlocks:
    return decontaminate.load_items(_table(spark, folder, "benchmark"))


def op2_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.hits(_table(spark, folder, "documents"), benchmark_items(spark, folder))


#: The key of the registered query; a deployment passes its own.
PSEUDONYM_KEY = "helioframe"


def op4_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    made = pseudonyms.pseudonymize(_table(spark, folder, "documents"), PSEUDONYM_KEY)
    count = [_count("found", kind).alias(f"n_{kind}") for kind in pseudonyms.KINDS]
    return made.select("doc_id", "text", *count)


def op5_near(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(_table(spark, folder, "documents")).drop("digest")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    tokenfile.write_tokens(_table(spark, folder, "documents"), byte_vocabulary(), path)
    return tokenfile.digests(tokenfile.read_tokens(spark, path))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    path = piece_model()
    return pieces.digests(pieces.decode(pieces.encode(_table(spark, folder, "documents"), path), path))


def op8_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    removed = free_name(docs, "__removed")
    cleaned = lines.clean(docs, removed=removed)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cleaned.select("doc_id", F.col(removed).alias("n_removed"), digest.alias("cleaned_sha256"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, folder, "documents"))


#: The rules of the URL filter.
RULES = [
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
]


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").filter("quality IS NOT NULL")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return urlfilter.judge(_table(spark, folder, "pages"), outcomes, RULES)


def op11_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = language.identify(docs, language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "rejected")


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(runs.repeat_tail(_table(spark, folder, "documents")))
    best = runs.strongest("runs")
    listed = found.withColumn("best", best).withColumn("n_runs", F.size("runs").cast("long"))
    return listed.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(runs.runs_text("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_benchmark": op2_benchmark,
    "op3_toxicity": op3_toxicity,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_near": op5_near,
    "op6_token_files": op6_token_files,
    "op7_pieces": op7_pieces,
    "op8_lines": op8_lines,
    "op9_fingerprints": op9_fingerprints,
    "op10_urls": op10_urls,
    "op11_language": op11_language,
    "op12_runs": op12_runs,
    "op13_search": op13_search,
}
ORACLES: dict[str, str] = {"op8_lines": lines.ORACLE_SQL, "op10_urls": urlfilter.oracle_sql(RULES), "op13_search": ranked.ORACLE_SQL}
