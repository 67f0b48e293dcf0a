"""Periodic runs of words, by uniting suffix classes in the order of descending common prefixes.

A run is a stretch of words with smallest period q that neither neighbour extends. If it starts at i, the suffixes
at i and i + q share all of the run but its first q words, and where the classes of suffixes that share so many
words form, i and i + q are neighbours in their class: a position between them would give a smaller period. So
suffixes are sorted by prefix doubling, neighbours get the length of their common prefix, and classes are united
by falling length with union-find, each holding its positions in order. Positions that become neighbours at a
distance within the length seed a run; the seeds of a run have its period and end in common, the least is its start.

All texts of a piece are worked on at once: words become numbers that no two texts share, so suffixes of different
texts share nothing. A run has at least ``LEAST`` words and ``TIMES`` periods, so its suffixes share
``SHARED`` words or more, and positions whose next ``SHARED`` words stand nowhere else in the text are left out at once.

Work is by row, without a shuffle. Defined results: a null text counts as empty and has no words and no run; repeated
rows and ids get a row each; a null id stays null; an empty table gives an empty result; extra columns are not read;
a long text is worked on whole, with memory in proportion to its words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

LEAST, TIMES = 6, 4
#: max(LEAST - q, (TIMES - 1) * q) over all periods q.
SHARED = min(max(LEAST - q, (TIMES - 1) * q) for q in range(1, LEAST))
PIECE = 1 << 20
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Places:
    """Positions in order, in blocks, so that putting one in moves few."""

    __slots__ = ("blocks", "heads", "size")
    BLOCK = 1024

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def add(self, x: int) -> None:
        at = max(bisect_right(self.heads, x) - 1, 0)
        block = self.blocks[at]
        insort(block, x)
        self.heads[at] = block[0]
        self.size += 1
        if len(block) > 2 * self.BLOCK:
            self.blocks.insert(at + 1, block[self.BLOCK :])
            self.heads.insert(at + 1, block[self.BLOCK])
            del block[self.BLOCK :]

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The neighbours of a position that is in the set."""
        at = bisect_right(self.heads, x) - 1
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.blocks[at - 1][-1] if at else None
        after = block[i + 1] if i + 1 < len(block) else self.heads[at + 1] if at + 1 < len(self.heads) else None
        return before, after

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    out = np.full(len(ranks), -1, dtype=np.int64)
    if by < len(ranks):
        out[:-by] = ranks[by:]
    return out


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left * (int(right.max()) + 2) + right + 1


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Ranks of the runs of ``SHARED`` symbols from each place, in one order of the symbols."""
    ranks, width = symbols, 1
    while width < SHARED:
        step = min(width, SHARED - width)
        ranks = np.unique(_joined(ranks, _shifted(ranks if step == width else symbols, width)), return_inverse=True)[1]
        width += step
    return ranks


assert SHARED == 5, "the widths of _grams are 1, 2, 4, 5"


def suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``SHARED`` symbols stand elsewhere too, in suffix order, and the common prefixes of neighbours.

    By prefix doubling on those places alone; a common prefix is read from the ranks of each doubling.
    """
    n, found = len(symbols), _grams(symbols)
    counts = np.bincount(found)
    ranks = (np.cumsum(counts) - counts)[found]
    active = every = np.flatnonzero(counts[found] > 1)
    levels, width = [(SHARED, np.append(ranks, -1).astype(np.int32))], SHARED
    while len(active):
        ahead = np.append(ranks, -1)[np.minimum(active + width, n)]
        key = ranks[active] * (n + 1) + ahead + 1
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = ranks[active]
        at = np.arange(len(active))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.concatenate([[True], old[1:] != old[:-1]])
        new_at, first_at = np.maximum.accumulate(at * new), np.maximum.accumulate(at * first)
        ranks = ranks.copy()
        ranks[active] = old + new_at - first_at
        alone = new & np.append(new[1:], True)
        active, width = active[~alone], 2 * width
        if len(active):
            levels.append((width, np.append(ranks, -1).astype(np.int32)))
    order = every[np.argsort(ranks[every], kind="stable")]
    i, j = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(i), dtype=np.int64)
    for width, level in reversed(levels):
        same = level[i] == level[j]
        for x in (i, j, shared):
            x[same] += width
    ends, open_ = np.append(symbols, -1), np.ones(len(i), dtype=bool)
    for _ in range(SHARED - 1):
        open_ &= (ends[np.minimum(i, n)] == ends[np.minimum(j, n)]) & (i < n) & (j < n)
        for x in (i, j, shared):
            x[open_] += 1
    return order, shared


def united(order: np.ndarray, shared: np.ndarray) -> dict[tuple[int, int], int]:
    """(period, end) and start of each run, from uniting the classes by falling common prefix."""
    places = order.tolist()
    parent = list(range(len(places)))
    classes: dict[int, Places] = {}
    edges = np.flatnonzero(shared >= SHARED)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    levels, edges = shared[edges].tolist(), edges.tolist()
    runs: dict[tuple[int, int], int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    at = 0
    while at < len(edges):
        level, moved = levels[at], {}
        while at < len(edges) and levels[at] == level:
            a, b = find(edges[at]), find(edges[at] + 1)
            at += 1
            if a in classes and (b not in classes or classes[a].size >= classes[b].size):
                a, b = b, a
            if b not in classes:
                classes[b] = Places(places[b])
            small = classes.pop(a, None) or (places[a],)
            into = classes[b]
            for x in small:
                into.add(x)
                moved.setdefault(x, a)
            parent[a] = b
        # Only now, when all classes of this length are whole, are neighbours what they are to be.
        # What moved out of one class together was seen before; what did not move stands in another class.
        for x, a in moved.items():
            before, after = classes[find(a)].around(x)
            for left, right in ((before, x), (x, after)):
                if left is not None and right is not None and moved.get(left, -1) != moved.get(right, -1):
                    period = right - left
                    if (TIMES - 1) * period <= level and level + period >= LEAST:
                        key = (period, right + level)
                        if left < runs.get(key, left + 1):
                            runs[key] = left
    return runs


def find_runs(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) by start and period, of the words with these codes; runs stay in one owner's words."""
    none = np.zeros((0, 3), dtype=np.int64)
    if len(codes) < LEAST:
        return none
    symbols = pd.factorize(owner * (int(codes.max()) + 1) + codes)[0].astype(np.int64)
    # Texts without a repeat of SHARED words leave here; no order is needed to see that.
    grams, width = symbols, 1
    for step in (1, 2, 1):
        grams = pd.factorize(_joined(grams, _shifted(grams if step == width else symbols, width)))[0]
        width += step
    repeats = np.bincount(grams)[grams] > 1
    if not repeats.any():
        return none
    some = np.zeros(int(owner[-1]) + 1, dtype=bool)
    some[owner[repeats]] = True
    kept = np.flatnonzero(some[owner])
    order, shared = suffixes(symbols[kept])
    found = united(order, shared)
    # Texts stay whole, so distances inside one are as they were.
    out = np.array([(kept[start], end - start, period) for (period, end), start in found.items()], dtype=np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    first = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > PIECE:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _found(texts: list[bytes]) -> list[pa.Array]:
    """n_words, runs and collapsed of each text."""
    split = [t.split() for t in texts]  # bytes split at 0x20 and 0x09 to 0x0D, and nowhere else
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    flat = [word for words in split for word in words]
    runs = np.zeros((0, 3), dtype=np.int64)
    if flat:
        codes = pd.factorize(np.fromiter(flat, dtype=object, count=len(flat)))[0]
        runs = find_runs(codes, np.repeat(np.arange(len(texts)), sizes))
    change = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(change[:-1]) > 0
    text_of = np.searchsorted(begins, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(text_of, np.arange(len(texts) + 1))
    with_run = set(text_of.tolist())
    collapsed = []
    for k, words in enumerate(split):
        if k in with_run:
            gone = dropped[begins[k] : begins[k + 1]].tolist()
            words = [word for word, out in zip(words, gone) if not out]
        collapsed.append(b" ".join(words))
    columns = [pa.array(runs[:, 0] - begins[text_of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    return [pa.array(sizes), listed, pa.array(collapsed, pa.binary()).view(pa.string())]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for first, last in _pieces(sizes):
            columns = _found(texts.slice(first, last - first).to_pylist())
            yield pa.record_batch([batch.column(0).slice(first, last - first), *columns], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start and period) and collapsed of every row.

    ``collapsed`` holds the words joined by one space, without those that a run holds after its first period.
    """
    return numbered_text(docs, id_col, text_col).mapInArrow(_search, SCHEMA)


def strongest(runs: str | Column = "runs") -> Column:
    """The run of the greatest length by period, compared exactly; of equals the first; null if there is none."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def runs_text(runs: str | Column = "runs") -> Column:
    """A line ``start,length,period`` for each run."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")


def repeat_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text, a tenth of the texts (by checksum h of the id) with a tail that repeats itself.

    With g = floor(h / 10) and n words, every word i from a = g % n on becomes word a + (i - a) % p of the text,
    p being 1 + floor((n - a) / (3 + g % 8)). A null id or a text without words is left as it is.
    """
    rows = numbered_text(docs, id_col, text_col)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = rows.withColumn("words", F.when(h % 10 == 0, words)).withColumn("g", F.floor(h / 10)).withColumn("n", F.size("words").cast("long"))
    tail = F.when(F.col("n") > 0, F.struct((F.col("g") % F.col("n")).alias("a")))
    a = F.col("tail.a")
    p = 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))
    chosen = chosen.withColumn("tail", tail).withColumn("p", p)
    source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % F.col("p"))
    pick = lambda i: F.get("words", source(i).cast("int"))
    edited = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), pick), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))
