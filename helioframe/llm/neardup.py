"""Near-duplicates: DartMinHash signatures of weighted five-word shingles, banded joining, exact verification.

Every shingle, weighted by how often it stands in the text, is cut into strips of weight one. Hashed darts
fall on a strip's rank axis like a Poisson process of rate one, those under a rank limit that shrinks with
the text's weight are looked at, and each of ``SIZE`` coordinates keeps its earliest dart. The limit doubles
for texts with an empty coordinate, so every kept dart is the earliest of the whole process, and two texts
agree in a coordinate with the probability of their weighted Jaccard similarity. ``BANDS`` bands of ``ROWS``
coordinates find a pair of similarity 0.8 with probability over 0.99999.

Equal texts are folded first. In each bucket texts are compared with its centre, the member that shares most buckets
with others, so a family meets in one text whatever its number of buckets; links count when the exact similarity is
0.8 or more. Then every pair of texts of different classes whose signatures agree in ``AGREE`` of
``SIZE`` coordinates is verified (two texts of similarity 0.8 do in all but 1 of 10,000 cases), unless a bound rules it
out: the weights of two texts of similarity 0.8 differ by a fifth at most, and in any common order of the shingles
such texts share one among their first ``floor(weight / 5) + 1`` (prefix filter), from which on both have as much as they
must have in common. The order is by rising number of texts, so what a family of texts has in common comes last. While
these pairs outnumber the texts, buckets are first compared again between one text of each class, in a salted order.
Classes are the connected components of the links, found by star contraction. ``n_links`` counts the verified links
that joined a text to its class; pairs inside a class that no step compared are not among them.

Defined results: null and empty texts are equal texts and so one class; texts without words are alike only
when equal; texts of fewer than five words have one shingle; repeated rows and ids each get a row; ``class_id``
is the least id of the class's documents (null only if none has an id), and as ids may be null or repeated,
``class_digest`` (the least digest of a text of the class) tells classes apart; an empty table gives an empty
result; extra columns are kept by ``one_of_each`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import discard, free_name, numbered_text, written
from helioframe.llm.wordhash import mix, shingles, words

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
#: At similarity 0.8 the number of equal coordinates has the mean 128 and the standard deviation 5.06.
AGREE = 108
#: Pairs are verified in slices of so many, so that the shingles of few texts are held at once.
_SLICE = 128
#: Texts of a shingle are paired in blocks of about this many on each side.
_SIDE = 1000
_DARTS = SIZE * (np.log(SIZE) + 2)
_CELLS = 1 << 18
_U = np.uint64
#: Cumulated Poisson probabilities for rate one, as 64-bit thresholds.
_POISSON = [int(c * (2.0**64 - 2**12)) for c in np.cumsum(np.exp(-1.0) / np.concatenate([[1.0], np.cumprod(np.arange(1.0, 18.0))]))]


def weights(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and how often each stands there."""
    return np.unique(hashes, return_counts=True)


def strips(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each unit of weight of each element."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(hashes, counts) + nth.astype(np.uint64) * _U(0xA0761D6478BD642F))


def _throw(units: np.ndarray, lo: int, hi: int, ranks: np.ndarray, darts: np.ndarray) -> None:
    """Throws the darts of rank ``lo`` to ``hi`` at all strips and keeps the earliest of each coordinate."""
    thresholds = np.array(_POISSON, dtype=np.uint64)
    step = max(1, _CELLS // max(hi - lo, 1))
    for first in range(0, len(units), step):
        part = units[first : first + step]
        cell = np.tile(np.arange(lo, hi, dtype=np.uint64), len(part))
        seed = mix(np.repeat(part, hi - lo) ^ (cell * _U(0xE7037ED1A0B428DB) + _U(0x589965CC75374CC3)))
        number = np.searchsorted(thresholds, seed, side="right")
        cell, seed = np.repeat(cell, number), np.repeat(seed, number)
        nth = np.arange(len(seed)) - np.repeat(np.cumsum(number) - number, number)
        dart = mix(seed + (nth + 1).astype(np.uint64) * _U(0x8EBC6AF09C88C6E3))
        rank = cell + (dart >> _U(11)).astype(np.float64) / 2.0**53
        spot = (mix(dart + _U(0x1D8E4E27C47D124F)) % _U(SIZE)).astype(np.int64)
        order = np.lexsort((dart, rank, spot))
        spot, rank, dart = spot[order], rank[order], dart[order]
        head = np.concatenate([[True], spot[1:] != spot[:-1]]) if len(spot) else np.zeros(0, dtype=bool)
        spot, rank, dart = spot[head], rank[head], dart[head]
        better = rank < ranks[spot]
        ranks[spot[better]], darts[spot[better]] = rank[better], dart[better]


def signature(units: np.ndarray) -> np.ndarray:
    """The earliest dart of each coordinate for a text with these strips."""
    ranks, darts = np.full(SIZE, np.inf), np.zeros(SIZE, dtype=np.uint64)
    lo, hi = 0, max(1, int(np.ceil(_DARTS / len(units))))
    while True:
        _throw(units, lo, hi, ranks, darts)
        if np.isfinite(ranks).all():
            return darts
        lo, hi = hi, 2 * hi


def band_keys(darts: np.ndarray) -> np.ndarray:
    """One key for each band; the band's number is part of it."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in darts.reshape(BANDS, ROWS).T:
        out = mix(out * _U(0xD6E8FEB86659FD93) + column)
    return out.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, hashes, begins in words(batch.column(2)):
            grams, cuts = shingles(hashes, begins, WORDS)
            darts = [signature(strips(*weights(grams[a:b]))) if b > a else None for a, b in zip(cuts[:-1], cuts[1:])]
            keys = pa.array([None if d is None else band_keys(d) for d in darts], type=pa.list_(pa.int64()))
            marks = pa.array([None if d is None else d.astype(np.uint8).view(np.int8) for d in darts], type=pa.list_(pa.int8()))
            part = batch.slice(first, last - first)
            yield pa.record_batch([part.column(0), part.column(1), keys, marks], names=["doc_id", "digest", "bands", "marks"])


def _digested(docs: DataFrame) -> DataFrame:
    return numbered_text(docs).select("doc_id", F.sha2("text", 256).alias("digest"), "text")


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of shingles with counts."""
    common, at, bt = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    least = np.minimum(left[1][at], right[1][bt]).sum()
    total = left[1].sum() + right[1].sum() - least
    return float(least / total) if total else 0.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
        sides = []
        for column in (2, 3):
            out = []
            for _, _, hashes, begins in words(batch.column(column)):
                grams, cuts = shingles(hashes, begins, WORDS)
                out.extend(weights(grams[a:b]) for a, b in zip(cuts[:-1], cuts[1:]))
            sides.append(out)
        alike = pa.array([similarity(a, b) >= SIMILAR for a, b in zip(*sides)], type=pa.bool_())
        yield pa.record_batch([batch.column(0), batch.column(1), alike], names=["a", "b", "alike"])


def _pairs(members: DataFrame, salt: int) -> DataFrame:
    """Each bucket's members with its first and last member in a salted order; ``a`` is less than ``b``."""
    order = F.struct(F.xxhash64(F.lit(salt), "digest"), "digest")
    ends = members.groupBy("bucket").agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    ends = ends.filter(F.col("lo.digest") != F.col("hi.digest"))
    ends = ends.select("bucket", F.explode(F.array("lo.digest", "hi.digest")).alias("end"))
    both = members.join(ends, "bucket").filter("digest != end")
    return both.select(F.least("digest", "end").alias("a"), F.greatest("digest", "end").alias("b")).distinct()


def _centre_pairs(members: DataFrame) -> DataFrame:
    """Each bucket's other members with its centre: the member with the greatest sum of the sizes of its buckets."""
    weighed = members.groupBy("digest").agg(F.sum("size").alias("shared"))
    ranked = members.join(weighed, "digest")
    centres = ranked.groupBy("bucket").agg(F.max_by("digest", F.struct("shared", "digest")).alias("centre"))
    both = members.join(centres, "bucket").filter("digest != centre")
    return both.select(F.least("digest", "centre").alias("a"), F.greatest("digest", "centre").alias("b")).distinct()


def _agreeing(left: str, right: str):
    """How many coordinates of two signatures are equal, by a byte of each."""
    equal = F.zip_with(left, right, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda total, one: total + one)


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one root and no root points on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node it is connected to, for all nodes of ``links(a, b)`` that are not roots."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, written(large.distinct(), "edges")
        discard(old)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, edges = edges, written(small, "edges")
        discard(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """node and root after more links: only the classes they join are worked on."""
    if roots is None:
        return components(links)
    end = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    named = links.join(end("a"), "a", "left").join(end("b"), "b", "left")
    named = named.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a != b")
    more = components(named)
    onward = more.select(F.col("node").alias("root"), F.col("root").alias("onward"))
    moved = roots.join(onward, "root", "left").select("node", F.coalesce("onward", "root").alias("root"))
    return written(moved.unionByName(more), "roots")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, hashes, begins in words(batch.column(2)):
            grams, cuts = shingles(hashes, begins, WORDS)
            bags = [weights(grams[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            distinct = [len(bag[0]) for bag in bags]
            at = pa.array(np.repeat(np.arange(first, last), distinct))
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.repeat(np.diff(cuts), distinct), pa.int64())]
            elements, many = (np.concatenate(x) for x in zip(*bags))
            columns += [pa.array(elements.view(np.int64)), pa.array(many, pa.int64())]
            yield pa.record_batch(columns, names=["text", "root", "weight", "element", "many"])


def _other_pairs(members: DataFrame, roots: DataFrame, whole: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes that share a bucket and may be alike by their signatures and bounds."""
    named = members.join(roots, F.col("digest") == F.col("node"), "left").select("bucket", "digest", F.coalesce("root", "digest").alias("root"))
    mixed = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("bucket")
    left = written(named.join(mixed, "bucket").select("digest", "root").distinct(), "left")
    units = whole.join(left, "digest").select(F.unhex("digest").alias("digest"), F.unhex("root").alias("root"), "text")
    units = written(units.mapInArrow(_units, "text binary, root binary, weight long, element long, many long"), "units")
    # A shingle of one class alone pairs no classes; such come first in the order.
    shared = units.groupBy("element").agg(F.count(F.lit(1)).alias("texts"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    shared = shared.filter("lo != hi").select("element", "texts")
    each = Window.partitionBy("text")
    before = F.coalesce(F.sum("many").over(each.orderBy("texts", "element").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.col("weight") - F.sum("many").over(each) + before
    prefix = units.join(shared, "element").withColumn("place", place)
    prefix = prefix.filter(F.col("place") < F.floor(F.col("weight") * (1 - SIMILAR) + 1e-6) + 1)
    old, prefix = units, written(prefix.select("element", "text", "root", "weight", (F.col("weight") - F.col("place")).alias("rest")), "prefix")
    discard(old)
    # No pairs inside the largest class of a shingle are made; both sides go in blocks.
    sizes = prefix.groupBy("element", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("element").agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("big"))
    sizes = sizes.filter("all > most").select(
        "element", "big", F.ceil((F.col("all") - F.col("most")) / _SIDE).cast("int").alias("p"), F.ceil(F.col("all") / _SIDE).cast("int").alias("q")
    )
    sided = prefix.join(sizes, "element").join(whole.select(F.unhex("digest").alias("text"), "marks"), "text")
    block = lambda n: F.pmod(F.xxhash64("text"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = sided.filter("root != big").select("element", block("p").alias("i"), every("q").alias("j"), F.col("text").alias("a"), F.col("root").alias("ra"), F.col("weight").alias("wa"), F.col("rest").alias("ea"), F.col("marks").alias("ma"))
    two = sided.select("element", every("p").alias("i"), block("q").alias("j"), F.col("text").alias("b"), F.col("root").alias("rb"), F.col("weight").alias("wb"), F.col("rest").alias("eb"), F.col("marks").alias("mb"))
    pairs = one.join(two, ["element", "i", "j"]).filter(F.col("ra") != F.col("rb"))
    pairs = pairs.filter(F.least("wa", "wb") >= F.greatest("wa", "wb") * SIMILAR - 1e-6)
    # All that two texts have in common stands from their first common shingle on.
    pairs = pairs.filter(F.least("ea", "eb") >= (F.col("wa") + F.col("wb")) * (SIMILAR / (1 + SIMILAR)) - 1e-6)
    pairs = pairs.filter(_agreeing("ma", "mb") >= AGREE)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.select(F.lower(F.hex("a")).alias("a"), F.lower(F.hex("b")).alias("b"))


def _alike(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    left = whole.select(F.col("digest").alias("a"), F.col("text").alias("left"))
    right = whole.select(F.col("digest").alias("b"), F.col("text").alias("right"))
    checked = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return written(checked.mapInArrow(_verify, "a string, b string, alike boolean").filter("alike").select("a", "b"), "links")


def text_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct texts (digest, doc_id, bands), the verified links (a, b) between their digests, and node and root of each that has one."""
    sketched = _digested(docs).mapInArrow(_sketches, "doc_id long, digest string, bands array<bigint>, marks array<tinyint>")
    texts = sketched.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    texts = written(texts, "texts")
    members = texts.select("digest", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(members.join(shared, "bucket"), "members")
    involved = texts.join(members.select("digest").distinct(), "digest", "left_semi").select("digest", F.col("doc_id").alias("first_id"), "marks")
    whole = _digested(docs).join(involved, "digest").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    whole = written(whole.select("digest", "text", "marks").dropDuplicates(["digest"]), "whole")
    pairs = written(_centre_pairs(members), "pairs")
    tried = pairs
    links = found = _alike(pairs, whole)
    roots, salt, many = components(links), 1, whole.count()
    while True:
        others = written(_other_pairs(members, roots, whole).join(tried, ["a", "b"], "left_anti"), "pairs")
        # As many pairs as texts are soon verified; of more, most may lie in classes that one more round would join.
        if found.isEmpty() or others.count() <= many:
            break
        discard(others)
        salt += 1
        # One member of each class in each bucket, another one each round.
        named = members.join(roots, F.col("digest") == F.col("node"), "left")
        named = named.select("bucket", "digest", F.coalesce("root", "digest").alias("root"))
        one = named.groupBy("bucket", "root").agg(F.min_by("digest", F.xxhash64(F.lit(salt), "bucket", "digest")).alias("digest"))
        pairs = written(_pairs(one, salt).join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        found = _alike(pairs, whole)
        roots, links = _joined(roots, found), links.unionByName(found)
    found = _alike(others, whole)
    roots, links = _joined(roots, found), links.unionByName(found)
    discard(members, whole, tried, others)
    return texts, links, roots


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links (verified links of its text), digest and class_digest of every row of ``docs``."""
    texts, links, roots = text_links(docs)
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ends.groupBy(F.col("a").alias("digest")).agg(F.count(F.lit(1)).alias("n_links"))
    roots = roots.withColumnRenamed("node", "digest")
    labelled = texts.select("digest", "doc_id").join(roots, "digest", "left")
    labelled = labelled.select("digest", "doc_id", F.coalesce("root", "digest").alias("class_digest"))
    least = labelled.groupBy("class_digest").agg(F.min("doc_id").alias("class_id"))
    labelled = labelled.join(least, "class_digest").join(degree, "digest", "left")
    labelled = written(labelled.select("digest", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "class_digest"), "classes")
    rows = _digested(docs).select("doc_id", "digest").join(labelled, "digest")
    return rows.select("doc_id", "class_id", "n_links", "digest", "class_digest")


def one_of_each(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each class: that with the least id."""
    labelled = classes(docs) if labelled is None else labelled
    # Of equal ids the least text stays; of rows equal in both, any one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = labelled.groupBy("class_digest").agg(first).select("first.doc_id", "first.digest")
    helper = free_name(docs, "__kept")
    name = lambda doc_id: F.coalesce(doc_id.cast("string"), F.lit("null"))
    key = F.struct(name(F.col("doc_id").cast("long")), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    kept = kept.select(F.struct(name(F.col("doc_id")), "digest").alias(helper))
    rows = docs.withColumn(helper, key).join(kept, helper, "left_semi")
    return rows.dropDuplicates([helper]).select(*[F.col(f"`{c}`") for c in docs.columns])
