"""SentencePiece encoding and decoding by vectorised merge rounds over flat numpy symbol arrays.

A text becomes words (runs of spaces belong to what follows; no piece of the vocabulary crosses the cut),
and every word not met lately goes through merge rounds together with the other new words: the rank of
each neighbouring pair, the least rank in each word, all its occurrences merged at once from the left, and
compaction, until no pair is left. A word in which a merge's product could start a better or equal pair (as in
a run of spaces, whose pieces all tie) has the merges of that round done in one scan from the left, so the order
is the library's and a long run takes one round. Characters without a piece become byte pieces.

Only the vocabulary is read from the model file; texts never pass through the library. The model has to be
BPE with byte fallback, a leading dummy space and no other normalization, which ``Vocabulary`` checks.

Defined results: a null or empty text has only the end id and decodes to an empty text; repeated rows are
encoded each; whole texts are encoded, in groups of about ``GROUP`` characters, and a long run of
spaces takes time in proportion to its length; extra columns are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

SPACE = "▁"
GROUP = 1 << 20
CACHE_WORDS = 150_000
LONG = 64
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Pieces, their ranks, and which two pieces make a third."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.size = size
        pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(size)]
        self.end = model.eos_id()
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        if not all(model.is_byte(int(i)) for i in self.byte) or any(model.is_unused(i) for i in range(size)):
            raise ValueError("the vocabulary needs byte pieces and no unused ones")
        if model.normalize(" ａ \t ") != SPACE * 2 + "ａ" + SPACE + "\t" + SPACE:
            raise ValueError("the model normalizes texts")
        ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.char = np.full(0x110000, -1, dtype=np.int32)
        keys, made = [], []
        self.safe = np.ones(size, dtype=bool)
        bigrams = set()
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
            for a, b in zip(piece, piece[1:]):
                bigrams.add((ord(a) << 21) | ord(b))
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    made.append(i)
                    for part in (left, right):
                        if self.rank[i] <= self.rank[part]:
                            self.safe[part] = False
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys, self.made = np.array(keys, dtype=np.int64)[order], np.array(made, dtype=np.int32)[order]
        self._sorted = array("q", self.keys.tobytes())
        self.bigrams = np.array(sorted(bigrams), dtype=np.int64)
        # Words may be cut before a space only where no piece has a space behind another character.
        crossing = any(a != SPACE and b == SPACE for p in ids for a, b in zip(p, p[1:]))
        self.words = None if crossing else re.compile(" *[^ ]+| +")
        raw = [self._bytes(model, i, pieces[i], plain[i]) for i in range(size)]
        self.lengths = np.array([len(b) for b in raw], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.spaced = np.array([plain[i] and pieces[i].startswith(SPACE) for i in range(size)])
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _bytes(model, i: int, piece: str, plain: bool) -> bytes:
        if model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if model.is_unknown(i):
            return " ⁇ ".encode()
        return piece.replace(SPACE, " ").encode() if plain else b""

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces make, or -1."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)

    def _join(self, left: int, right: int) -> tuple[int, int]:
        """Rank and piece that two symbols make; the piece is -1 if none."""
        key = left * self.size + right
        at = bisect_left(self._sorted, key) if left >= 0 and right >= 0 else len(self._sorted)
        if at == len(self._sorted) or self._sorted[at] != key:
            return _NONE, -1
        made = int(self.made[at])
        return int(self.rank[made]), made

    def _scan(self, symbols: list[int], limit: int) -> tuple[list[int], list[int]]:
        """One word after all its merges up to a rank, given that no pair is better: what is left, and where it begins.

        Only a new piece can make a better pair, so going from the left, the best of its two pairs comes next.
        """
        out: list[int] = []
        begins: list[int] = []
        at = 0
        while at < len(symbols):
            top, begin = symbols[at], at
            at += 1
            while top >= 0:
                left = self._join(out[-1], top) if out else (_NONE, -1)
                right = self._join(top, symbols[at]) if at < len(symbols) else (_NONE, -1)
                if min(left[0], right[0]) > limit:
                    break
                if left[0] <= right[0]:
                    top, begin = left[1], begins.pop()
                    out.pop()
                else:
                    top, at = right[1], at + 1
            out.append(top)
            begins.append(begin)
        return out, begins

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, all words going through the merge rounds together."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word_of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        joined = np.isin((codes[:-1] << 21) | codes[1:], self.bigrams) & (word_of[1:] == word_of[:-1])
        segment = np.concatenate([[0], np.cumsum(~joined)])
        symbol, place = self.char[codes], np.arange(len(codes))
        last = np.append(segment[1:] != segment[:-1], True)
        made = np.where(last, -1, self._made(symbol, np.append(symbol[1:], -1)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            rank = np.where(made >= 0, self.rank[made], _NONE)
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(least != _NONE, sizes)
            if not open_.all():
                done.append((place[~open_], symbol[~open_]))
                symbol, place, segment, made, rank = (x[open_] for x in (symbol, place, segment, made, rank))
                sizes, least = sizes[least != _NONE], least[least != _NONE]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            # Of touching pairs every other one, from the left.
            fresh = np.concatenate([[True], (np.diff(hit) > 1) | (segment[hit[1:]] != segment[hit[:-1]])])
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            # A pair alone in its word never waits.
            several = np.bincount(segment[hit])[segment[hit]] > 1
            waiting = np.unique(segment[hit[several & ~self.safe[made[hit]]]])
            hit = hit[~np.isin(segment[hit], waiting) & ((np.arange(len(hit)) - run) % 2 == 0)]
            symbol[hit] = made[hit]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hit + 1] = False
            changed = np.zeros(len(symbol), dtype=bool)
            changed[hit] = True
            for a, b in zip(np.searchsorted(segment, waiting), np.searchsorted(segment, waiting, side="right")):
                left, begins = self._scan(symbol[a:b].tolist(), int(rank[a:b].min()))
                keep[a:b] = False
                keep[a + np.array(begins)] = True
                symbol[a + np.array(begins)] = left
                changed[a:b] = True
            symbol, place, segment, made, changed = (x[keep] for x in (symbol, place, segment, made, changed))
            changed[:-1] |= changed[1:]
            at = np.flatnonzero(changed)
            after = np.minimum(at + 1, len(symbol) - 1)
            inside = (after > at) & (segment[after] == segment[at])
            made[at] = np.where(inside, self._made(symbol[at], symbol[after]), -1)
        place = np.concatenate([d[0] for d in done])
        symbol = np.concatenate([d[1] for d in done])
        order = np.argsort(place)
        place, symbol = place[order], symbol[order]
        owner = word_of[place]
        if (symbol < 0).any():
            spelt = [(chr(codes[p]).encode() if s < 0 else b"") for p, s in zip(place, symbol)]
            counts = np.array([len(b) or 1 for b in spelt])
            symbol, owner = np.repeat(symbol, counts), np.repeat(owner, counts)
            symbol[symbol < 0] = self.byte[np.frombuffer(b"".join(spelt), dtype=np.uint8)]
        cuts = np.searchsorted(owner, np.arange(len(words) + 1))
        flat = symbol.astype(np.int32).tobytes()
        ends = (cuts * 4).tolist()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def _split(self, text: str) -> list[str]:
        """The words of a text, each without the space every word begins with."""
        if not text or self.words is None:
            return [text] if text else []
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in self.words.findall(" " + text.replace(SPACE, " "))]
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers, without an end id."""
        split = [self._split(t) for t in texts]
        if len(self.cache) > CACHE_WORDS:  # frequent words are met first, so the older half is kept
            self.cache = dict(islice(self.cache.items(), CACHE_WORDS // 2))
        new = list(set().union(*split).difference(self.cache))
        if new:
            self.cache.update(zip(new, self.encode_words([SPACE + w.replace(" ", SPACE) for w in new])))
        encoded = [b"".join(map(self.cache.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > LONG:
                del self.cache[word]
        return encoded

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[str]:
        """Texts of flat ids; ``begins`` has one more entry than there are texts."""
        lengths, start = self.lengths[ids], self.begins[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.data[np.repeat(start - total[:-1], lengths) + np.arange(total[-1])].tobytes()
        out = []
        visible = np.flatnonzero(lengths)
        firsts = np.searchsorted(visible, begins[:-1])
        for a, b, first in zip(begins[:-1], begins[1:], firsts):
            spaced = first < len(visible) and visible[first] < b and self.spaced[ids[visible[first]]]
            out.append(data[total[a] + int(spaced) : total[b]].decode("utf-8", "replace"))
        return out


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, read once in each Python process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > GROUP:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def encode(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """doc_id and ``ids``, the token ids of each row's whole text, with the end id last if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        tail = np.array([vocab.end] if end else [], dtype=np.int32).tobytes()
        for batch in batches:
            for a, b in _groups(pc.utf8_length(batch.column(1)).to_pylist()):
                found = [i + tail for i in vocab.encode(batch.column(1).slice(a, b - a).to_pylist())]
                cuts = np.concatenate([[0], np.cumsum([len(i) // 4 for i in found])]).astype(np.int32)
                flat = np.frombuffer(b"".join(found), dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))
                yield pa.record_batch([batch.column(0).slice(a, b - a), ids], names=["doc_id", "ids"])

    return numbered_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` with ``decoded``, the text the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            ids = batch.column(1)
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).tolist()
            for a, b in _groups(sizes):
                begins = np.concatenate([[0], np.cumsum(sizes[a:b])]).astype(np.int64)
                flat = ids.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pa.array(vocab.decode(flat, begins), type=pa.string())
                yield pa.record_batch([batch.column(0).slice(a, b - a), ids.slice(a, b - a), texts], names=["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
