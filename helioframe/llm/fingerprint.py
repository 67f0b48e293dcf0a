"""Document fingerprints from prefix polynomial hashes.

For a text c_0 .. c_(n-1) of code points the prefix arrays hold the sums of c_j * B**j up to each place, modulo
two primes. They give the hash of any span in constant time, so any two spans of any two texts can be compared,
and the longest common extension of two places is found by binary search.

A fingerprint is the length, the two hashes of the whole text, and the ``KEPT`` least mixed hashes of its
spans of ``SPAN`` code points (a text shorter than that is one span). The likeness of two fingerprints is the
share of the least ``KEPT`` of both that stand in both: an estimate of the Jaccard similarity of the span sets.

Neighbours in the order of the ids come from one shuffle into ranges of ids, bounded by approximate quantiles; an id that
fills several ranges is divided by the hash of the text. The first text of each range, from one aggregation, is sent to
the range before it as its last row, so every row meets the one after it in its own task and nothing is stored.

Defined results: a null text counts as empty; two empty texts have likeness 1, an empty and another text 0;
a single document is its own next; rows of equal ids come in the order of a hash of their text; repeated rows
get a row each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text
from helioframe.llm.wordhash import mix

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 88172645)
SPAN = 24
KEPT = 64
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling."""
    if which not in _tables or len(_tables[which][0]) < size:
        p, wanted, out = PRIMES[which], max(size, 1 << 16), []
        for base in (BASES[which], pow(BASES[which], -1, PRIMES[which])):
            powers = np.ones(1, dtype=np.int64)
            while len(powers) < wanted:
                powers = np.concatenate([powers, powers * pow(base, len(powers), p) % p])
            out.append(powers)
        _tables[which] = (out[0], out[1])
    return _tables[which]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.size = codes, len(codes)
        self.sums = []
        for which, p in enumerate(PRIMES):
            up, _ = _powers(which, self.size + 1)
            sums = np.zeros(self.size + 1, dtype=np.int64)
            # Each term is under 2**31, so a running sum of up to 2**32 terms stays exact.
            np.cumsum((codes + 1) * up[: self.size] % p, out=sums[1:])
            sums %= p
            self.sums.append(sums)

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        """The hashes of the code points from start to stop (exclusive), wherever they stand."""
        out = []
        for which, p in enumerate(PRIMES):
            sums, down = self.sums[which], _powers(which, self.size + 1)[1]
            out.append(int((sums[stop] - sums[start]) % p * down[start] % p))
        return tuple(out)

    def same(self, start: int, other: PrefixHash, at: int, size: int) -> bool:
        return self.span(start, start + size) == other.span(at, at + size)

    def extension(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common extension of two places."""
        lo, hi = 0, min(self.size - start, other.size - at)
        while lo < hi:
            middle = (lo + hi + 1) // 2
            lo, hi = (middle, hi) if self.same(start, other, at, middle) else (lo, middle - 1)
        return lo

    def spans(self) -> np.ndarray:
        """Mixed hashes of all spans of ``SPAN`` code points, from both primes."""
        n, size = max(self.size - SPAN + 1, min(self.size, 1)), min(SPAN, self.size)
        both = np.full(n, size, dtype=np.uint64)
        for which, p in enumerate(PRIMES):
            sums, down = self.sums[which], _powers(which, self.size + 1)[1]
            found = (sums[size : size + n] - sums[:n]) % p * down[:n] % p
            both = both * np.uint64(1 << 31) + found.astype(np.uint64)
        return mix(both)

    def whole(self) -> str:
        return f"{self.size:x}-" + "".join(f"{h:08x}" for h in self.span(0, self.size))


def least(hashes: np.ndarray) -> np.ndarray:
    """The ``KEPT`` least distinct hashes, ascending."""
    wanted = 4 * KEPT
    while len(hashes) > wanted:
        found = np.unique(np.partition(hashes, wanted)[:wanted])
        if len(found) >= KEPT:
            return found[:KEPT]
        wanted *= 4
    return np.unique(hashes)[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = np.unique(np.concatenate([a, b]))[:KEPT]
    return float((np.isin(both, a) & np.isin(both, b)).mean()) if len(both) else 1.0


def fingerprint(hashes: PrefixHash, kept: np.ndarray) -> str:
    return hashes.whole() + "-" + kept.astype(">u8").tobytes().hex()


def edited(codes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half of the code points replaced by the first as many of the next text, or all it has."""
    half = len(codes) // 2
    return np.concatenate([codes[: len(codes) - half], following[:half]])


#: Ranges of ids for each shuffle partition.
RANGES = 4
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_start"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_start long"


class _Text:
    """A text with its prefix arrays and least span hashes, worked out once."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.hashes = PrefixHash(code_points(text))
        self.kept = least(self.hashes.spans())


def _compared(one: _Text, following: _Text) -> tuple:
    codes = edited(one.hashes.codes, following.hashes.codes)
    other = PrefixHash(codes)
    kept = least(other.spans())
    digest = hashlib.sha256(codes.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
    return (
        one.doc_id,
        one.hashes.size,
        digest,
        fingerprint(one.hashes, one.kept),
        fingerprint(other, kept),
        likeness(one.kept, kept),
        likeness(one.kept, following.kept),
        one.hashes.extension(0, following.hashes, 0),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of the ranges; the last row of a range is the first text of the next and has none."""
    before: _Text | None = None
    for batch in batches:
        rows = []
        for doc_id, text, last in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "last"))):
            here = _Text(doc_id, text)
            if before is not None:
                rows.append(_compared(before, here))
            before = None if last else here
            if len(rows) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def id_ranges(bounds: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bounds, descending, the ranges before each one's own, and the ranges that its rows alone take.

    ``bounds`` are quantiles; one that comes r times is an id that fills r - 1 whole ranges and a part of two others.
    """
    values, times = np.unique(np.array(bounds, dtype=np.int64), return_counts=True)
    values, times = values[::-1], times[::-1]
    own = np.where(times > 1, times, 0)
    # Rows above a bound share a range with no other bound's; then come the rows of the bound itself.
    return values, np.arange(1, len(values) + 1) + np.cumsum(own) - own, own


def range_of(ids: np.ndarray, none: np.ndarray, places: np.ndarray, ranges: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The number of the range of each row, rising in the order of falling id, then place; null ids come last."""
    values, first, own = ranges
    if not len(values):
        return none.astype(np.int64)
    above = len(values) - np.searchsorted(values[::-1], ids, side="right")  # bounds greater than the id
    at = np.minimum(above, len(values) - 1)
    hot = (values[at] == ids) & (own[at] > 0)
    share = (places.astype(np.float64) / 2.0**64 + 0.5) * own[at]
    inside = first[at] + np.minimum(share.astype(np.int64), own[at] - 1)
    plain = np.where(above == 0, 0, first[above - 1] + own[above - 1])
    return np.where(none, first[-1] + own[-1] + 1, np.where(hot, inside, plain))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row, of its edited text, and their likeness to its own and to the next row's.

    The next row has the next lower id; that of the last is the first. ``same_start`` is the length of the
    longest common prefix with the next row's text.
    """
    rows = numbered_text(docs).withColumn("place", F.xxhash64("text"))
    many = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("doc_id", [k / many for k in range(1, many)], 10 * many)).first()[0]
    ranges = id_ranges(found or [])  # one number a range

    @F.pandas_udf("long")
    def numbered(ids: pd.Series, places: pd.Series) -> pd.Series:
        none = ids.isna().to_numpy()
        return pd.Series(range_of(ids.fillna(0).to_numpy().astype(np.int64), none, places.to_numpy(), ranges))

    # Null ids reach the function as a number and a mark of their own, so that large ids are never rounded.
    known = F.coalesce("doc_id", F.lit(0))
    last_range = F.lit(int(ranges[1][-1] + ranges[2][-1] + 1) if len(ranges[0]) else 1)
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), last_range).otherwise(numbered(known, "place")))
    order = F.struct(F.bitwise_not("doc_id").alias("id"), "place")
    heads = rows.groupBy("range").agg(F.min_by("text", F.struct(F.col("doc_id").isNull().alias("none"), order.alias("order"))).alias("text"))
    follows = heads.select("range", F.lead("range").over(Window.orderBy("range")).alias("next"), F.min("range").over(Window.partitionBy()).alias("first"))
    ends = follows.select(F.coalesce("next", "first").alias("range"), F.col("range").alias("before")).join(heads, "range")
    ends = ends.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("place"), F.col("before").alias("range"), F.lit(True).alias("last"))
    both = rows.withColumn("last", F.lit(False)).unionByName(ends)
    both = both.repartition("range").sortWithinPartitions("range", "last", F.desc_nulls_last("doc_id"), "place")
    return both.select("doc_id", "text", "last").mapInArrow(_walk, _SCHEMA)
