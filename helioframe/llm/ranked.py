"""Ranked lexical search: item vocabulary tiles times document impact tiles, multiplied densely in float64.

A term is a maximal run of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased. With N documents that
hold a term, L terms in all, n terms in a document, df documents that hold a term and tf occurrences in the document,
a term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), a document's length measure m is 10 + (90 n N) div L, and a
score is the sum of weight * ((10**9 * tf) div (1000 * tf + 8 * m)) over the item's terms.

One pass over all texts counts N, L and df; a second takes the documents of a task in tiles of ``DOCS`` and the items
in tiles of ``ITEMS``, whose own terms alone make up a tile's vocabulary. Both tiles are dense, so BLAS multiplies
them. All factors are whole numbers: an impact is at most 10**6, a weight under 1000 * ln(2N + 2), so the ``TERMS``
products of one multiplication sum to less than 2**53 and stay exact; wider vocabularies go in slices whose sums are
added as 64-bit integers. A task keeps the best ``k`` of each item in the order of falling score and rising id, which
loses no tie, and the lists of all tasks meet in a window per item.

Items are taken in blocks of ``BLOCK`` bytes of text, one after the other: what a block sends to the tasks (its terms,
weights and the terms of each item) is bounded by it. An item of more text is a block of its own.

Defined results: null texts have no terms; items without terms or without a hit give no rows; rows of equal item_id are
one item with the terms of all; a null item_id is an item like others; of documents with equal scores the lower id
comes first, a null id last; repeated rows rank each; empty tables give an empty result; extra columns are not read;
texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

K = 10
ITEMS, DOCS, TERMS = 64, 256, 4096
BLOCK = 8 << 20
PIECE = 4 << 20
_LAST = np.iinfo(np.int64).max
#: Bytes as they count: letters and digits, lower-cased, and non-ASCII bytes; all others end a term.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """All terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


class Block(NamedTuple):
    """Items and the sorted terms they hold; ``held`` are the places of each item's terms, once each."""

    ids: list[int | None]
    vocabulary: list[bytes]
    held: list[np.ndarray]


class Counts(NamedTuple):
    documents: int
    length: int
    holding: np.ndarray


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = BLOCK) -> Iterator[Block]:
    """The items in order of their ids, in blocks; the driver holds one at a time."""
    rows = numbered_text(items, id_col, text_col).orderBy("doc_id")
    found: dict[int | None, set[bytes]] = {}
    total = 0
    for row in rows.toLocalIterator():
        held = terms(row["text"].encode("utf-8", "surrogatepass"))
        if row["doc_id"] not in found and total and total + len(row["text"]) > size:
            yield _block(found)
            found, total = {}, 0
        found.setdefault(row["doc_id"], set()).update(held)
        total += len(row["text"])
    if found:
        yield _block(found)


def _block(found: dict[int | None, set[bytes]]) -> Block:
    vocabulary = sorted(set().union(*found.values()))
    place = {term: k for k, term in enumerate(vocabulary)}
    held = [np.array(sorted(place[t] for t in some), dtype=np.int32) for some in found.values()]
    return Block(list(found), vocabulary, held)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of at most ``DOCS`` texts and about ``PIECE`` bytes."""
    first = total = 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if i > first and (total + size > PIECE or i - first >= DOCS):
            yield first, i
            first, total = i, 0
        total += size
    if first < len(texts):
        yield first, len(texts)


def _occurrences(texts: list[bytes], place: dict[bytes, int]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of terms; text, place and number of occurrences of all terms of the vocabulary."""
    split = [terms(t) for t in texts]
    size = [len(s) for s in split]
    codes = np.fromiter((c for s in split for c in map(place.get, s, repeat(-1))), dtype=np.int64, count=sum(size))
    known = codes >= 0
    key, tf = np.unique(np.repeat(np.arange(len(texts)), size)[known] * max(len(place), 1) + codes[known], return_counts=True)
    return size, key // max(len(place), 1), key % max(len(place), 1), tf


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_string()).cast(pa.large_binary())


def corpus_counts(docs: DataFrame, vocabulary: list[bytes]) -> Counts:
    """N, L and the df of each term; every task sends one row for each term it has met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: k for k, term in enumerate(vocabulary)}
        holding = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            texts = _binary(batch.column(0))
            for a, b in _pieces(texts):
                size, _, at, _ = _occurrences(texts.slice(a, b - a).to_pylist(), place)
                holding[:-2] += np.bincount(at, minlength=len(vocabulary))
                holding[-2] += sum(s > 0 for s in size)
                holding[-1] += sum(size)
        met = np.flatnonzero(holding)
        yield pa.record_batch([pa.array(met, pa.int64()), pa.array(holding[met])], names=["at", "many"])

    summed = numbered_text(docs, "doc_id").select("text").mapInArrow(count, "at long, many long").groupBy("at").agg(F.sum("many").alias("many"))
    holding = np.zeros(len(vocabulary) + 2, dtype=np.int64)
    for row in summed.toLocalIterator():  # at most one row a term of the block
        holding[row["at"]] = row["many"]
    return Counts(int(holding[-2]), int(holding[-1]), holding[:-2])


def weights(counts: Counts) -> np.ndarray:
    """The whole-number weight of each term."""
    return np.array([math.floor(1000 * math.log((2 * counts.documents + 2) / (2 * df + 1))) for df in counts.holding.tolist()], dtype=np.int64)


class _Tile(NamedTuple):
    """Items from ``first`` on; the places of their terms, which say the tile's own; weights by item and own place."""

    first: int
    own: np.ndarray
    weights: np.ndarray


def _tiles(block: Block, weight: np.ndarray) -> list[_Tile]:
    out = []
    for first in range(0, len(block.held), ITEMS):
        held = block.held[first : first + ITEMS]
        own = np.unique(np.concatenate(held))
        dense = np.zeros((len(held), len(own)))
        for k, at in enumerate(held):
            dense[k, np.searchsorted(own, at)] = weight[at]
        out.append(_Tile(first, own, dense))
    return out


def _scores(tile: _Tile, document: np.ndarray, at: np.ndarray, impact: np.ndarray, documents: int) -> np.ndarray:
    """Exact scores of the tile's items and the documents; ``at`` are places of terms, ``impact`` whole numbers."""
    place = np.searchsorted(tile.own, at)
    place[place == len(tile.own)] = 0
    mine = tile.own[place] == at if len(tile.own) else np.zeros(len(at), dtype=bool)
    document, place, impact = document[mine], place[mine], impact[mine]
    total = np.zeros((len(tile.weights), documents), dtype=np.int64)
    for lo in range(0, len(tile.own), TERMS):
        width = min(TERMS, len(tile.own) - lo)
        inside = (place >= lo) & (place < lo + width)
        dense = np.zeros((width, documents))
        dense[place[inside] - lo, document[inside]] = impact[inside]
        total += (tile.weights[:, lo : lo + width] @ dense).astype(np.int64)
    return total


class _Best:
    """The best ``k`` documents of each item so far; order: score falling, null ids last, id rising."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.rows = np.zeros((0, 4), dtype=np.int64)  # item, score, null id, id
        self.waiting: list[np.ndarray] = []
        self.many = 0

    def put(self, first: int, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(item):
            self.waiting.append(np.stack([item + first, scores[item, doc], none[doc], ids[doc]], axis=1))
            self.many += len(item)
            if self.many > 1 << 16:
                self.settle()

    def settle(self) -> None:
        rows = np.concatenate([self.rows, *self.waiting])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begins = np.searchsorted(rows[:, 0], np.arange(len(self.least) + 1))
        nth = np.arange(len(rows)) - begins[rows[:, 0]]
        self.rows, self.waiting, self.many = rows[nth < self.k], [], 0
        # A later document needs the score of the last kept one at least: equal scores are told apart by id.
        full = rows[nth == self.k - 1]
        self.least[full[:, 0]] = full[:, 1]


def block_top(docs: DataFrame, block: Block, k: int = K) -> DataFrame:
    """item_id, score and doc_id of each task's best ``k`` documents of each item of the block."""
    counts = corpus_counts(docs, block.vocabulary)
    tiles, vocabulary, ids = _tiles(block, weights(counts)), block.vocabulary, block.ids
    documents, length = counts.documents, counts.length

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: k for k, term in enumerate(vocabulary)}
        best = _Best(len(ids), k)
        for batch in batches:
            texts = _binary(batch.column(1))
            none = pc.is_null(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            doc_ids = pc.fill_null(batch.column(0), _LAST).to_numpy(zero_copy_only=False)
            for a, b in _pieces(texts):
                size, document, at, tf = _occurrences(texts.slice(a, b - a).to_pylist(), place)
                if not len(at):
                    continue
                # n * N may pass 64 bits, so it is worked out in whole numbers of any size.
                m = np.array([10 + 90 * n * documents // length for n in size], dtype=np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[document])
                for tile in tiles:
                    best.put(tile.first, _scores(tile, document, at, impact, b - a), none[a:b], doc_ids[a:b])
        best.settle()
        item, score, null, doc = best.rows.T
        columns = [pa.array([ids[i] for i in item.tolist()], pa.int64()), pa.array(score), pa.array(doc, mask=null == 1)]
        yield pa.record_batch(columns, names=["item_id", "score", "doc_id"])

    return numbered_text(docs).mapInArrow(search, "item_id long, score long, doc_id long")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item, in all of ``docs``."""
    found = [block_top(docs, block, k) for block in item_blocks(items, size=block_bytes)]
    if not found:
        found = [docs.sparkSession.createDataFrame([], "item_id long, score long, doc_id long")]
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


_TERM_SQL = r"regexp_extract_all(translate({0}.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH doc_terms AS (SELECT d.doc_id, unnest({_TERM_SQL.format("d")}) AS term FROM documents d),
item_terms AS (SELECT DISTINCT b.item_id, unnest({_TERM_SQL.format("b")}) AS term FROM benchmark b),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
wanted AS (SELECT DISTINCT term FROM item_terms),
weights AS (
  SELECT t.term, CAST(floor(1000 * ln((2 * any_value(s.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs t JOIN wanted USING (term) CROSS JOIN totals s GROUP BY t.term),
impacts AS (
  SELECT t.doc_id, t.term, w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * z.n * s.docs) // s.terms))) AS points
  FROM tfs t JOIN weights w USING (term) JOIN sizes z USING (doc_id) CROSS JOIN totals s),
scores AS (SELECT i.item_id, p.doc_id, CAST(sum(p.points) AS BIGINT) AS score FROM item_terms i JOIN impacts p USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank" FROM scores WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 10
"""
