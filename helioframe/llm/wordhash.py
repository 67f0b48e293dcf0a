"""Words of Arrow string columns as 64-bit hashes, worked out on the UTF-8 bytes with numpy.

A word is a run of ASCII letters, digits, underscores and non-ASCII characters. Its hash is a polynomial
over its lower-cased bytes, taken from a prefix sum, so no Python object is made per word. Work goes in
pieces of about ``PIECE`` bytes, cut between words, so that memory beyond the hashes stays bounded however
long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_tables: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["up"]) < size:
        n = max(size, PIECE + 4096)
        for name, base in (("up", _P), ("down", _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in the bytes; ``begins`` are places where a text begins."""
    inside = _WORD[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[begins] = True
    cut[-1] = True
    starts = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.append(inside[1:], False)
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return flat, places


def words(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first index, index after the last, word hashes, and where each text's words begin.

    The last array has one more entry than there are texts in the run.
    """
    if len(texts) == 0:
        return
    _, sizes = _buffers(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(sizes, sizes[first] + PIECE, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        # Only the texts of this run are lower-cased at once, so no copy of the whole array is held.
        run = texts.slice(first, last - first)
        data, places = _buffers(pc.utf8_lower(pc.fill_null(run.cast(pa.large_string()), "")) if lower else run)
        lo, hi = int(places[0]), int(places[-1])
        if last - first > 1 or hi - lo <= PIECE:
            begins = places - lo
            starts, _, hashes = _piece_words(data[lo:hi], begins)
            yield first, last, hashes, np.searchsorted(starts, begins)
        else:
            hashes = np.concatenate([_piece_words(data[a:b], np.zeros(1, dtype=np.int64))[2] for a, b in _cuts(data, lo, hi)])
            yield first, last, hashes, np.array([0, len(hashes)])
        first = last


def _cuts(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Pieces of one long text, each ending before a byte that is in no word."""
    while lo < hi:
        end = min(lo + PIECE, hi)
        while end < hi and _WORD[data[end]]:
            ahead = np.flatnonzero(~_WORD[data[end : end + PIECE]])
            end = end + int(ahead[0]) if len(ahead) else min(end + PIECE, hi)
        yield lo, end
        lo = end


def owners(begins: np.ndarray) -> np.ndarray:
    """For each word of a run, the index of its text in the run."""
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))


def shingles(hashes: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each text's shingles begin.

    A text of fewer words has one shingle, of all its words; a text without words has none.
    """
    counts = np.diff(begins)
    n = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    out_begins = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.arange(out_begins[-1]) - out_begins[:-1][owner] + begins[:-1][owner]
    left = np.minimum(counts, size)[owner]
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(size):
        there = left > j
        word = np.zeros(len(at), dtype=np.uint64)
        word[there] = hashes[at[there] + j]
        out = out * np.uint64(_P) + word
    return mix(out + left.astype(np.uint64)), out_begins
