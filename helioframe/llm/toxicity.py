"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every text is a set of hashed features: single words, word pairs, and pairs with one or two words left out
between them. Training reads a bounded sample of labelled texts; per-coordinate rates let rare words learn
as fast as common ones, and the L1 term leaves most weights at exactly zero, so the model that is sent to
the tasks has at most ``2 ** BITS`` entries whatever the corpus holds.

Defined results: a null or empty text has no features and scores the model's bias; equal texts score alike;
repeated rows are scored each; a table without labels gives a model of zeros (score 0.5); extra columns are
kept as they are by ``reject_toxic`` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text, place_of, whole_text
from helioframe.llm.wordhash import mix, owners, words

BITS = 20
#: At most this many labelled texts are learnt from: the documented bound of the sample.
SAMPLE_ROWS = 16_000
THRESHOLD = 0.7
_KINDS = 4
_SALTS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], dtype=np.uint64)


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by ascending feature number, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float32)
        out[self.features] = self.weights
        return out


def _features(hashes: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: owner text and feature number, repeats included."""
    owner = owners(begins)
    shift = np.uint64(64 - BITS)
    for kind in range(_KINDS):
        salt = _SALTS[kind]
        if kind == 0:
            yield owner, (mix(hashes + salt) >> shift).astype(np.int64)
        elif len(hashes) > kind:
            same = owner[kind:] == owner[:-kind]
            pair = hashes[:-kind] * np.uint64(0xD1342543DE82EF95) + hashes[kind:] + salt
            yield owner[:-kind][same], (mix(pair[same]) >> shift).astype(np.int64)


def text_features(texts: pa.Array) -> list[np.ndarray]:
    """The sorted feature numbers of each text."""
    out: list[np.ndarray] = []
    for first, last, hashes, begins in words(texts):
        parts = list(_features(hashes, begins))
        owner = np.concatenate([p[0] for p in parts])
        number = np.concatenate([p[1] for p in parts])
        keys = np.unique((owner.astype(np.int64) << BITS) | number)
        cuts = np.searchsorted(keys, np.arange(last - first + 1, dtype=np.int64) << BITS)
        number = (keys & ((1 << BITS) - 1)).astype(np.int32)
        out.extend(number[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
    return out


def ftrl(examples: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.1, epochs: int = 8) -> Model:
    """One FTRL-proximal pass after another over the examples, in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    bias = 0.0

    def weight(z, n):
        shrunk = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, shrunk / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for features, label in zip(examples, labels):
            zi, ni = z[features], n[features]
            w = weight(zi, ni)
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
            margin = bias + w.sum()
            g = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))) - label
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[features] = zi + g - sigma * w
            n[features] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = weight(z, n)
    kept = np.flatnonzero(w)
    return Model(kept, w[kept].astype(np.float32), float(bias))


def scores(model: Model, dense: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 for each text; each feature of a text counts once."""
    out = np.full(len(texts), model.bias)
    for first, last, hashes, begins in words(texts):
        owner_parts, number_parts = [], []
        for owner, number in _features(hashes, begins):
            hit = np.flatnonzero(dense[number])
            owner_parts.append(owner[hit])
            number_parts.append(number[hit])
        keys = np.unique((np.concatenate(owner_parts).astype(np.int64) << BITS) | np.concatenate(number_parts))
        out[first:last] += np.bincount(keys >> BITS, weights=dense[keys & ((1 << BITS) - 1)], minlength=last - first)
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts, chosen and ordered by a hash of the id, so by nothing they say.

    An id with several labels has the largest; repeated rows of a document are one example each.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = marks.withColumn("place", F.xxhash64(F.lit(17), "doc_id")).orderBy("place", "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # At most ``rows`` rows of an id, a label and a place, so the texts of all other documents stay where they are.
    return texts.join(F.broadcast(chosen), "doc_id").orderBy("place", "doc_id", "text").limit(rows).select("text", "label")


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples: list[np.ndarray] = []
    labels: list[np.ndarray] = []
    for batch in batches:
        examples.extend(text_features(batch.column(0)))
        labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(float))
    if not examples:
        return
    model = ftrl(examples, np.concatenate(labels))
    feature, weight = np.append(model.features, -1), np.append(model.weights, model.bias).astype(float)
    yield pa.record_batch([pa.array(feature, pa.int64()), pa.array(weight, pa.float64())], names=["feature", "weight"])


def train(sample: DataFrame) -> Model:
    """The model of a bounded sample, learnt in one task; only its non-zero weights come to the driver."""
    rows = sample.coalesce(1).mapInArrow(_train, "feature long, weight double").toPandas()
    rows = rows.sort_values("feature")
    bias = float(rows.loc[rows["feature"] < 0, "weight"].sum())
    kept = rows[rows["feature"] >= 0]
    return Model(kept["feature"].to_numpy(np.int64), kept["weight"].to_numpy(np.float32), bias)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shipped.value.dense()
        for batch in batches:
            found = scores(shipped.value, dense, batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(found, type=pa.float64())], names=["doc_id", "score"])

    return numbered_text(docs).mapInArrow(run, "doc_id long, score double")


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under the threshold, with all their columns, in one pass without a shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = place_of(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shipped.value.dense()
        for batch in batches:
            found = scores(shipped.value, dense, batch.column(at).cast(pa.large_string()))
            yield batch.filter(pa.array(found < threshold))

    return docs.mapInArrow(run, docs.schema)
