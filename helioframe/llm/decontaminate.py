"""Benchmark decontamination: CGK random-walk embeddings, bit-sampling LSH, exact edit verification.

Texts and items are word sequences, and a passage matches an item of n words when their word edit distance
is at most ``floor(0.2 n)``. The CGK embedding walks along a sequence with hashed coin flips, staying or
stepping on after each copied word, so sequences of small edit distance agree in most places of the output.
Each walk is sampled several times at ``BITS`` places; a window that falls in the bucket of an item in any of
them is compared with the item exactly.

The embedded distance grows with the square of the edits, so an item of more than ``LONGEST`` words is embedded
in pieces of equal size: of any match within the bound, at least one piece is within the bound of its own size,
and one piece found is enough to compare the whole item. The number of walks and samples follows from the
piece's size: the least for which trial texts with evenly spread substitutions, deletions, insertions or random
edits, as many as the bound allows, are found with probability ``TARGET`` (``plan``). An item of several pieces
has a chance with each, so its recall is not lower.

Windows have the size of the item or piece and lie where the edit bound allows a match at all: with at most d
edits in n words, some run of ``ceil((n - d) / (d + 1))`` words stands unchanged in the passage, so windows are
laid out from such runs (of up to four words). Windows of equal words are embedded and compared once, so a text
that repeats itself costs no more than its distinct windows.

The items are the stated query set, sent to all tasks in blocks bounded by what they hold when prepared; one
block at a time is in the driver, and documents are never shuffled. A single item is never cut over blocks.
Defined results: null and empty texts and items without words match nothing; repeated items match
each; repeated rows give their hits each; of several hits of an item in a text the one of least distance,
then the first, is returned; a null item id is an id like any other; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text, place_of, whole_text, written
from helioframe.llm.wordhash import mix, words

#: Probability with which a match at the edit limit is found.
TARGET = 0.99
#: Places of an embedding that make a bucket.
BITS = 3
#: Words of the longest sequence that is embedded whole.
LONGEST = 32
#: Walks and samples of each, by rising cost.
_PLANS = [(1, 1), (2, 6), (4, 8), (4, 16), (6, 16), (8, 16), (8, 24), (8, 32), (12, 32), (16, 32), (16, 48), (24, 48), (32, 64), (64, 64)]
_TRIALS = 300
#: Prepared items are sent to the tasks in blocks of about this many bytes.
MOST_BYTES = 64 << 20
#: Most bytes a word, and an item beside its words, may take when prepared.
_WORD_BYTES, _ITEM_BYTES = 1024, 4096
_U = np.uint64
_CELLS = 1 << 17
_PAIRS = 1 << 18


def allowed(n: np.ndarray | int):
    """Edits allowed in an item of n words."""
    return np.asarray(n) // 5


def run_length(n: int) -> int:
    """Words of an item that must stand unchanged side by side in any match."""
    d = int(allowed(n))
    return -(-(n - d) // (d + 1))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words at each place that has as many."""
    n = max(len(hashes) - size + 1, 0)
    return _row_hashes(np.stack([hashes[j : j + n] for j in range(size)], axis=1))


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of all words of each row."""
    out = np.full(len(rows), rows.shape[1], dtype=np.uint64)
    for j in range(rows.shape[1]):
        out = mix(out * _U(0x9E3779B97F4A7C15) + rows[:, j])
    return out


def walk(windows: np.ndarray, number: int) -> np.ndarray:
    """The CGK embedding of each row: 2n words; 0 behind the end."""
    rows, n = windows.shape
    out = np.zeros((rows, 2 * n), dtype=np.uint64)
    at, every = np.zeros(rows, dtype=np.int64), np.arange(rows)
    for step in range(2 * n):
        inside = at < n
        word = np.where(inside, windows[every, np.minimum(at, n - 1)], _U(0))
        out[:, step] = word
        coin = mix(word ^ _U(((number << 32) | (step + 1)) * 0x9E3779B97F4A7C15 & (2**64 - 1))) & _U(1)
        at += inside & (coin == 1)
    return out


def places(n: int, walks: int, samples: int) -> np.ndarray:
    """The sampled places of each walk and sample, the same for all windows of n words."""
    rng = np.random.default_rng(7919 * n + 11)
    return rng.integers(0, 2 * n, size=(walks, samples, BITS))


def buckets(windows: np.ndarray, walks: int, samples: int) -> np.ndarray:
    """A bucket for each row and each sample of each walk; 0, no bucket, where a sample sees only the places behind the end."""
    n = windows.shape[1]
    spots, keys = places(n, walks, samples), []
    for number in range(walks):
        embedded = walk(windows, number)
        for sample in range(samples):
            key = np.full(len(windows), (n << 16) | (number << 8) | sample, dtype=np.uint64)
            for spot in spots[number, sample]:
                key = mix(key * _U(0xD6E8FEB86659FD93) + embedded[:, spot])
            keys.append(np.where(embedded[:, spots[number, sample]].any(axis=1), key, _U(0)))
    return np.stack(keys, axis=1)


def _edited(item: np.ndarray, kind: str, rng: np.random.Generator) -> np.ndarray:
    """The item with as many edits as the bound allows: evenly spread ones of a kind, or any at random places."""
    n, d = len(item), int(allowed(len(item)))
    spread = {n * j // d for j in range(d)}
    out, chosen = [], set(rng.permutation(n)[:d]) if kind == "any" else spread
    for j, word in enumerate(item):
        edit = rng.choice(["swap", "drop", "add"]) if kind == "any" else kind
        if j not in chosen:
            out.append(word)
        elif edit != "drop":
            out.append(rng.integers(1 << 62))
            if edit == "add":
                out.append(word)
    return np.array(out, dtype=np.uint64)


@cache
def plan(n: int) -> tuple[int, int]:
    """Walks and samples of each that find a sequence of n words with ``TARGET`` at its edit limit.

    Tried on random words from a fixed seed, with the same windows and buckets as texts, for each kind of edit.
    """
    if int(allowed(n)) == 0:
        return _PLANS[0]
    rng, size = np.random.default_rng(n), run_length(n)
    kinds = ["swap", "drop", "add", "any"]
    wanted, windows, trial = [], [], []
    for number in range(_TRIALS * len(kinds)):
        item = rng.integers(1 << 62, size=n).astype(np.uint64)
        around = rng.integers(1 << 62, size=4 * n).astype(np.uint64)
        text = np.concatenate([around[: 2 * n], _edited(item, kinds[number // _TRIALS], rng), around[2 * n :]])
        known, here = grams(item, size), grams(text, size)
        for start in {int(at) - int(place) for place in range(len(known)) for at in np.flatnonzero(here == known[place])}:
            wanted.append(item)
            windows.append(text[start : start + n])
            trial.append(number)
    trial = np.array(trial)
    wanted, windows = np.stack(wanted), np.stack(windows)
    for walks, samples in _PLANS:
        left = buckets(wanted, walks, samples)
        hit = ((left == buckets(windows, walks, samples)) & (left != 0)).any(axis=1)
        found = np.bincount(trial, hit, _TRIALS * len(kinds)).reshape(len(kinds), _TRIALS) > 0
        if found.mean(axis=1).min() >= TARGET:
            return walks, samples
    return _PLANS[-1]


def distance(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of the item to any part of each row, and where the first best part ends."""
    rows, m = regions.shape
    steps = np.arange(m + 1)
    before = np.zeros((rows, m + 1), dtype=np.int64)
    for i, word in enumerate(item):
        now = np.empty_like(before)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(before[:, :-1] + (regions != word), before[:, 1:] + 1)
        before = np.minimum.accumulate(now - steps, axis=1) + steps
    end = before.argmin(axis=1)
    return before[np.arange(rows), end], end


@dataclass(frozen=True)
class Items:
    """The items' ids and words, their pieces (item, first word), and by number of words of a piece its buckets.

    ``runs`` holds for each size of an unchanged run its hashes, the piece's words and the place in the piece.
    """

    ids: list
    words: list[np.ndarray]
    piece_item: np.ndarray
    piece_first: np.ndarray
    plans: dict[int, tuple[int, int]]
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    buckets: dict[int, tuple[np.ndarray, np.ndarray]]


def prepare(ids: list, texts: list[str]) -> Items:
    hashes: list[np.ndarray] = []
    for _, _, flat, begins in words(pa.array(texts, type=pa.large_string())):
        hashes.extend(flat[a:b] for a, b in zip(begins[:-1], begins[1:]))
    owner, first, sized = [], [], {}
    for k, item in enumerate(hashes):
        number = -(-len(item) // LONGEST)
        bounds = [len(item) * j // number for j in range(number + 1)] if number else []
        for a, b in zip(bounds[:-1], bounds[1:]):
            sized.setdefault(b - a, []).append(len(owner))
            owner.append(k)
            first.append(a)
    runs: dict[int, list] = {}
    tables, plans = {}, {}
    for n, members in sized.items():
        pieces = np.stack([hashes[owner[p]][first[p] : first[p] + n] for p in members])
        size = run_length(n)
        for place in range(n - size + 1):
            # A window follows from the run, the size and the place alone, so pieces that share these count once.
            found = np.unique(_row_hashes(pieces[:, place : place + size]))
            runs.setdefault(size, []).append((found, np.full(len(found), n), np.full(len(found), place)))
        plans[n] = plan(n)
        keys = buckets(pieces, *plans[n])
        some = keys.ravel() != 0
        tables[n] = _sorted(keys.ravel()[some], np.repeat(np.array(members), keys.shape[1])[some])
    found = {size: _sorted(*(np.concatenate(x) for x in zip(*parts))) for size, parts in runs.items()}
    return Items(ids, hashes, np.array(owner, dtype=np.int64), np.array(first, dtype=np.int64), plans, found, tables)


def _sorted(keys: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    return keys[order], *(x[order] for x in others)


def _matches(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an index into ``keys`` and one into ``sorted_keys`` with equal keys."""
    lo, hi = np.searchsorted(sorted_keys, keys, "left"), np.searchsorted(sorted_keys, keys, "right")
    number = hi - lo
    left = np.repeat(np.arange(len(keys)), number)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(lo, number)


def _slices(sorted_keys: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of ``keys`` that have about ``_PAIRS`` partners, however often a key repeats."""
    partners = np.searchsorted(sorted_keys, keys, "right") - np.searchsorted(sorted_keys, keys, "left")
    total = np.cumsum(partners + 1)
    first = 0
    while first < len(keys):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + _PAIRS, side="right")))
        yield first, last
        first = last


def _windows(items: Items, flat: np.ndarray, owner: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of words: text and start of each window in which a piece may lie."""
    span, texts = len(flat) + 2 * LONGEST, int(owner[-1]) + 1 if len(owner) else 0
    found = []
    for size, (keys, lengths, place) in items.runs.items():
        here = grams(flat, size)
        if len(here):
            inside = np.flatnonzero(owner[: len(here)] == owner[size - 1 :])
            for first, last in _slices(keys, here[inside]):
                at, run = _matches(keys, here[inside[first:last]])
                at = inside[first + at]
                found.append(np.unique((lengths[run] * texts + owner[at]) * span + at - place[run] + LONGEST))
    code = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    start, rest = code % max(span, 1) - LONGEST, code // max(span, 1)
    length, text = rest // max(texts, 1), rest % max(texts, 1)
    return {int(n): (text[length == n], start[length == n]) for n in np.unique(length)}


def _distinct(flat: np.ndarray, begins: np.ndarray, text: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One index of each different stretch of ``size`` words, and for each stretch which of these it equals."""
    step, marks = max(1, _CELLS // size), []
    for first in range(0, len(start), step):
        cut = _cut(flat, begins, text[first : first + step], start[first : first + step], size)
        marks.append(_row_hashes(cut))
    _, one, which = np.unique(np.concatenate(marks), return_index=True, return_inverse=True)
    return one, which


def _candidates(items: Items, flat: np.ndarray, begins: np.ndarray, windows: dict) -> np.ndarray:
    """Item, text and start of the whole item, for each window that shares a bucket with a piece of it."""
    span, texts = len(flat) + 2 * max((len(w) for w in items.words), default=0) + 2 * LONGEST, len(begins) - 1
    back, found = span - len(flat) - LONGEST, [np.zeros(0, dtype=np.int64)]
    for n, (text, start) in windows.items():
        one, which = _distinct(flat, begins, text, start, n)
        order = np.argsort(which, kind="stable")
        groups = which[order]
        known, owner = items.buckets[n]
        step = max(1, _CELLS // (2 * n))
        for first in range(0, len(one), step):
            rows = one[first : first + step]
            keys = buckets(_cut(flat, begins, text[rows], start[rows], n), *items.plans[n])
            at, hit = _matches(known, keys.ravel())
            pairs = np.unique((first + at // keys.shape[1]) * len(items.piece_item) + owner[hit])
            group, piece = pairs // len(items.piece_item), pairs % len(items.piece_item)
            for a, b in _slices(groups, group):
                pair, member = _matches(groups, group[a:b])
                p, w = piece[a + pair], order[member]
                found.append(np.unique((items.piece_item[p] * texts + text[w]) * span + start[w] - items.piece_first[p] + back))
    code = np.unique(np.concatenate(found))
    rest = code // span
    return np.stack([rest // max(texts, 1), rest % max(texts, 1), code % span - back])


def find(items: Items, flat: np.ndarray, begins: np.ndarray) -> list[tuple[int, int, int, int]]:
    """text, item, edits and end word of each item's best match in each text of a run of texts."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    items_of, texts, starts = _candidates(items, flat, begins, _windows(items, flat, owner))
    best = []
    for k in np.unique(items_of):
        n, d = len(items.words[k]), int(allowed(len(items.words[k])))
        # Windows of one match start up to d words apart; a region takes in all starts of a stretch of d + 1.
        code = np.unique(np.stack([texts[items_of == k], starts[items_of == k] // (d + 1)]), axis=1)
        text, start, width = code[0], code[1] * (d + 1) - 2 * d, n + 5 * d
        one, which = _distinct(flat, begins, text, start, width)
        edits, ends = np.empty(len(one), dtype=np.int64), np.empty(len(one), dtype=np.int64)
        step = max(1, _CELLS // width)
        for first in range(0, len(one), step):
            rows = one[first : first + step]
            regions = _cut(flat, begins, text[rows], start[rows], width)
            edits[first : first + step], ends[first : first + step] = distance(items.words[k], regions)
        edits, end = edits[which], start + ends[which] - begins[text]
        order = np.lexsort((end, edits, text))
        order = order[edits[order] <= d]
        order = order[np.unique(text[order], return_index=True)[1]]
        best.extend((int(text[i]), int(k), int(edits[i]), int(end[i])) for i in order)
    return sorted(best)


def _cut(flat: np.ndarray, begins: np.ndarray, text: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """``size`` words from ``start`` on; places outside the text hold a word that equals no other."""
    at = start[:, None] + np.arange(size)
    inside = (at >= begins[text][:, None]) & (at < begins[text + 1][:, None])
    return np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], _U(1))


class ItemBlocks(Sequence):
    """The items of a benchmark in blocks; each is collected and prepared when it is asked for, and not kept."""

    def __init__(self, rows: DataFrame, number: int):
        self.rows, self.number = rows, number

    def __len__(self) -> int:
        return self.number

    def __getitem__(self, k: int) -> Items:
        if not 0 <= k < self.number:
            raise IndexError(k)
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.number)) == k
        rows = self.rows.filter(block) if self.number > 1 else self.rows
        found = rows.orderBy("item_id", "text").collect()
        return prepare([r["item_id"] for r in found], [r["text"] for r in found])


def load_items(benchmark: DataFrame, item_id: str = "item_id", most_bytes: int = MOST_BYTES) -> ItemBlocks:
    """The items in blocks that take about ``most_bytes`` at most when prepared; one block where all fit."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole_text().alias("text"))
    words_at_most = F.ceil((F.octet_length("text") + 1) / 2)
    size = rows.agg(F.coalesce(F.sum(words_at_most * _WORD_BYTES + _ITEM_BYTES), F.lit(0))).first()[0]
    return ItemBlocks(rows, max(1, -(-int(size) // most_bytes)))


def _block_hits(docs: DataFrame, items: Items) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            for first, last, flat, begins in words(batch.column(1)):
                found = find(known, flat, begins)
                if found:
                    text, item, edits, end = (list(x) for x in zip(*found))
                    ids = batch.column(0).slice(first, last - first).take(pa.array(text))
                    columns = [ids, pa.array([known.ids[k] for k in item], pa.int64()), pa.array(edits, pa.int64()), pa.array(end, pa.int64())]
                    yield pa.record_batch(columns, names=["doc_id", "item_id", "edits", "end_word"])

    return numbered_text(docs).mapInArrow(run, "doc_id long, item_id long, edits long, end_word long")


def hits(docs: DataFrame, items: Sequence[Items]) -> DataFrame:
    """doc_id, item_id, edits and end_word of every item found in every row of ``docs``."""
    if len(items) == 1:
        return _block_hits(docs, items[0])
    return reduce(DataFrame.unionByName, [written(_block_hits(docs, block), "hits") for block in items])


def _without_block(docs: DataFrame, items: Items) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(items)
    at = place_of(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for first, _, flat, begins in words(batch.column(at).cast(pa.large_string())):
                for text, *_ in find(shipped.value, flat, begins):
                    keep[first + text] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def reject_contaminated(docs: DataFrame, items: Sequence[Items]) -> DataFrame:
    """The rows without any item, with all their columns, without a shuffle."""
    if len(items) == 1:
        return _without_block(docs, items[0])
    return reduce(lambda kept, block: written(_without_block(kept, block), "clean"), items, docs)
