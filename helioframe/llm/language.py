"""Language by the nearest centroid of TF-IDF vectors, with several centroids for each language.

A text is lower-cased, all ASCII but letters becomes a space, runs of spaces become one, and the runs of 2, 3 and 4
bytes of its UTF-8 form are hashed to ``SIZE`` coordinates. A coordinate's value is log(1 + count) times the inverse
document frequency of the coordinate over all documents that may be learnt from; vectors have length one.

Of each language up to ``SAMPLE`` distinct texts, chosen by a hash of the text, are clustered by spherical k-means to
``CLUSTERS`` centroids of length one. This is the only part that learns from a sample; the document frequencies
are those of all texts. At most ``LANGUAGES`` languages (the most frequent) are learnt, which bounds the model, its
sample, and what is sent to the tasks.

A text belongs to the language of the centroid of greatest cosine, which is its score. A centroid also has a reach:
the mean distance (1 - cosine) of its sample texts and ``SPREAD`` standard deviations. A text beyond the reach of its
nearest centroid is rejected: ``language`` is ``und``, while ``nearest`` still names the centroid's language.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text where nothing could be
learnt; of equal cosines the language that sorts first counts; null labels and null texts are not learnt from; repeated
rows get a row each and count once in the sample; an empty table gives an empty result; columns other than id, text
and label are not read; texts are read whole, long ones piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

SIZE = 1 << 13
GRAMS = (2, 3, 4)
CLUSTERS = 4
ROUNDS = 12
SAMPLE = 1000
LANGUAGES = 256
SPREAD = 4.0
NONE = "und"
TEXTS, PIECE = 256, 1 << 20
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b | 32 if 65 <= b <= 90 else 32 for b in range(256)], dtype=np.uint8)
_SHIFT = np.uint32(32 - 13)
_MULTIPLIER = np.uint32(0x9E3779B1)


class Model(NamedTuple):
    """Languages in order, inverse document frequencies, and the language, place and reach of each centroid."""

    languages: list[str]
    idf: np.ndarray
    owner: np.ndarray
    centroids: np.ndarray
    reach: np.ndarray


def _count(data: np.ndarray, cuts: np.ndarray, out: np.ndarray, stop: int | None = None) -> None:
    """Adds the hashed n-grams of the texts between the cuts to their rows; those from ``stop`` on are left out."""
    folded = _FOLD[data]
    space = folded == 32
    kept = ~space
    kept[1:] |= ~space[:-1]
    begins = cuts[:-1][cuts[:-1] < len(data)]
    kept[begins] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    codes, cuts = folded[kept].astype(np.uint32), place[cuts]
    sizes = np.diff(cuts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(cuts[1:], sizes) - np.arange(len(codes))
    if stop is not None:
        row, left = row[: place[stop]], left[: place[stop]]
    gram = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        gram = gram[:-1] * np.uint32(256) + codes[n - 1 :]
        if n in GRAMS:
            whole = np.flatnonzero(left[: len(gram)] >= n)
            mixed = gram[whole] * _MULTIPLIER + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * _MULTIPLIER
            key = row[whole] * SIZE + (mixed >> _SHIFT)
            out += np.bincount(key, minlength=out.size).reshape(out.shape)


def counted(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """For runs of texts: first index, index after the last, and a row of n-gram counts for each text."""
    texts = pc.utf8_lower(texts.cast(pa.large_string()))
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(cuts, cuts[first] + PIECE, side="right")) - 1
        last = min(max(last, first + 1), first + TEXTS, len(texts))
        lo, hi = int(cuts[first]), int(cuts[last])
        out = np.zeros((last - first, SIZE))
        if hi - lo <= PIECE:
            if hi > lo:
                _count(flat[lo:hi], cuts[first : last + 1] - lo, out)
        else:  # one long text; an n-gram counts in the piece that it begins in
            for a in range(lo, hi, PIECE):
                b = min(a + PIECE, hi)
                part = flat[a : min(b + max(GRAMS) - 1, hi)]
                _count(part, np.array([0, len(part)]), out, b - a)
        yield first, last, out
        first = last


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; a text without n-grams has the zero vector."""
    found = np.log1p(counts) * idf
    size = np.sqrt((found * found).sum(axis=1, keepdims=True))
    return found / np.where(size > 0, size, 1.0)


def clusters(points: np.ndarray, many: int = CLUSTERS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one and their reach, by spherical k-means from points far from each other."""
    centres = [points.mean(axis=0)]
    near = points @ centres[0] / max(np.linalg.norm(centres[0]), 1e-12)
    for _ in range(many - 1):
        centres.append(points[int(near.argmin())])
        near = np.maximum(near, points @ centres[-1])
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        owner = (points @ centres.T).argmax(axis=1)
        centres = np.stack([points[owner == c].mean(axis=0) for c in range(len(centres)) if (owner == c).any()])
    centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    cosine = points @ centres.T
    owner, far = cosine.argmax(axis=1), 1 - cosine.max(axis=1)
    reach = [far[owner == c].mean() + SPREAD * far[owner == c].std() if (owner == c).any() else 0.0 for c in range(len(centres))]
    return centres, np.array(reach)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies of the coordinates over all rows of ``docs(text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SIZE + 1, dtype=np.int64)
        for batch in batches:
            for _, _, counts in counted(batch.column(0)):
                held[:-1] += (counts > 0).sum(axis=0)
                held[-1] += len(counts)
        met = np.flatnonzero(held)
        yield pa.record_batch([pa.array(met, pa.int64()), pa.array(held[met])], names=["at", "many"])

    summed = docs.mapInArrow(count, "at long, many long").groupBy("at").agg(F.sum("many").alias("many"))
    held = np.zeros(SIZE + 1)
    for row in summed.collect():  # at most SIZE + 1 rows
        held[row["at"]] = row["many"]
    return np.log((1 + held[-1]) / (1 + held[:-1])) + 1


def _sampled(learnt: DataFrame, languages: list[str]) -> DataFrame:
    """language (its number) and text: up to ``SAMPLE`` distinct texts of each language, by the least hash."""
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("label")) - 1
    rows = learnt.filter(F.col("label").isin(languages)).select(number.cast("int").alias("language"), F.xxhash64("text").alias("hash"), "text")
    # A first cut by the number of texts leaves a few times the sample, so the exact choice has few rows to order.
    sizes = rows.groupBy("language").agg(F.approx_count_distinct("hash").alias("texts")).collect()  # a row a language
    share = F.lit(1.0)
    for row in sizes:
        share = F.when(F.col("language") == row["language"], min(1.0, 4 * SAMPLE / max(row["texts"], 1))).otherwise(share)
    place = (F.col("hash").cast("double") / 2.0**64) + 0.5
    few = rows.select("language", "hash").filter(place <= share).distinct()
    nth = F.row_number().over(Window.partitionBy("language").orderBy("hash"))
    few = few.withColumn("nth", nth).filter(F.col("nth") <= SAMPLE).select("language", "hash")
    # At most LANGUAGES * SAMPLE rows of an int and a long.
    picked = rows.join(F.broadcast(few), ["language", "hash"])
    return picked.groupBy("language", "hash").agg(F.first("text").alias("text"))


def train(docs: DataFrame, learn: Column, text_col: str = "text", label_col: str = "lang") -> Model:
    """The model from the text and the label of the rows for which ``learn`` holds."""
    learnt = docs.filter(learn).select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    learnt = learnt.filter(has_letter("text") & F.col("label").isNotNull())
    many = learnt.groupBy("label").agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("many"), "label").limit(LANGUAGES)
    languages = sorted(row["label"] for row in many.collect())
    if not languages:
        return Model([], np.ones(SIZE), np.zeros(0, int), np.zeros((0, SIZE)), np.zeros(0))
    idf = document_frequencies(learnt.select("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, counts in counted(batch.column(2)):
                part = batch.slice(a, b - a)
                held = [row.tobytes() for row in vectors(counts, idf).astype(np.float32)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(held, pa.binary())], names=["language", "hash", "vector"])

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("hash")
        points = np.stack([np.frombuffer(v, dtype=np.float32) for v in group["vector"]]).astype(float)
        centres, reach = clusters(points)
        held = [row.astype(np.float32).tobytes() for row in centres]
        return pd.DataFrame({"language": group["language"].iloc[0], "centroid": held, "reach": reach})

    sketched = _sampled(learnt, languages).mapInArrow(sketch, "language int, hash long, vector binary")
    rows = sketched.groupBy("language").applyInPandas(cluster, "language int, centroid binary, reach double").collect()
    rows.sort(key=lambda r: (r["language"], bytes(r["centroid"])))
    centroids = np.stack([np.frombuffer(bytes(r["centroid"]), dtype=np.float32) for r in rows])
    return Model(languages, idf, np.array([r["language"] for r in rows]), centroids, np.array([r["reach"] for r in rows]))


def has_letter(text: str | Column) -> Column:
    return F.col(text).rlike(r"\p{L}") if isinstance(text, str) else text.rlike(r"\p{L}")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, language, nearest (without rejection), score (the cosine) and rejected of every row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, counts in counted(batch.column(1)):
                part = batch.slice(a, b - a)
                letter = part.column(2).to_numpy(zero_copy_only=False)
                cosine = vectors(counts, model.idf) @ model.centroids.T
                best = cosine.argmax(axis=1)
                score = np.where(letter, np.clip(cosine[np.arange(b - a), best], 0.0, 1.0), 0.0)
                rejected = ~letter | (1 - score > model.reach[best])
                nearest = [model.languages[o] if there else NONE for o, there in zip(model.owner[best], letter)]
                language = [NONE if out else n for out, n in zip(rejected, nearest)]
                columns = [part.column(0), pa.array(language), pa.array(nearest), pa.array(score), pa.array(rejected)]
                yield pa.record_batch(columns, names=["doc_id", "language", "nearest", "score", "rejected"])

    rows = numbered_text(docs, id_col, text_col)
    if not model.languages:
        none = F.lit(NONE)
        return rows.select("doc_id", none.alias("language"), none.alias("nearest"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    rows = rows.withColumn("letter", has_letter("text"))
    return rows.mapInArrow(judge, "doc_id long, language string, nearest string, score double, rejected boolean")
