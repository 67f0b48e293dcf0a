"""Token ids in Parquet files: list columns, dictionary and delta encoding, small row groups, page indexes.

Documents are laid out by ascending id in one range shuffle; every task encodes its range and Spark's
Parquet writer stores it, so a lost executor only repeats its own files and the commit shows whole files.
Token ids are dictionary encoded, ids and counts delta encoded (format version 2), and pages are short,
with the column indexes the format has, so that a reader of a few documents, or of the counts alone,
opens little of a file.

A document's place in the stream of all ids is the sum of what stands before it: inside a file by a window
over the file's counts, and between files by their totals, of which the driver keeps one number a file,
as it does for the listing itself.

Defined results: a null or empty text has the end id alone; documents with equal ids lie in the order of a
hash of their text and then the text; null ids come first; repeated rows are stored each; texts are encoded
whole; an empty table gives no documents; extra columns are not read.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

END = 0
CACHE_WORDS = 500_000
GROUP = 8 << 20
JOINED = 64 << 10
ROW_GROUP = 32 << 20
PAGE = 128 << 10
PAGE_ROWS = 500
LONG = 64
PAD = b"   "
SCHEMA = "doc_id long, text_key long, n_tokens long, tokens array<int>"

_BYTE = np.arange(256)
_BLANK = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)) | ((_BYTE >= 28) & (_BYTE <= 31))
_ASCII_LETTER = ((_BYTE | 32) >= ord("a")) & ((_BYTE | 32) <= ord("z"))
#: White space beyond ASCII, in UTF-8.
_WIDE_BLANK = [c.encode() for c in map(chr, range(128, 0x10000)) if c.isspace()]
_BLANK_2 = np.array([int.from_bytes(c) for c in _WIDE_BLANK if len(c) == 2])
_BLANK_3 = np.array([int.from_bytes(c) for c in _WIDE_BLANK if len(c) == 3])
#: Letters of two bytes that every version of Unicode in use agrees on.
_LETTER_2 = np.array([unicodedata.ucd_3_2_0.category(chr(c))[0] == unicodedata.category(chr(c))[0] == "L" for c in range(0x800)])


def _begins_word(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether what follows the space at each place is no white space; three bytes must follow every place."""
    first, second, third = (data[places + i].astype(np.int64) for i in (1, 2, 3))
    wide = np.isin(first << 8 | second, _BLANK_2) | np.isin(first << 16 | second << 8 | third, _BLANK_3)
    return ~_BLANK[first] & ~wide


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the places where the ids on both sides do not depend on each other, under the vocabulary's own rule.

    A space before something that is no white space begins a word, whatever stands before it. Nothing but
    letters goes on after a letter in a word, so a word also ends between a letter and an ASCII character
    that is none. ``data`` has ``PAD`` after the texts, which begin at ``starts``.
    """
    n = len(data) - len(PAD)
    texts = data[:n]
    cut = np.zeros(n + 1, dtype=bool)
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts] = edge[n] = True
    spaces = np.flatnonzero(texts == 32)
    spaces = spaces[~edge[spaces + 1]]
    cut[spaces[_begins_word(data, spaces)]] = True
    ascii_letter = _ASCII_LETTER[texts]
    other = (texts < 128) & ~ascii_letter
    cut[1:n] |= ascii_letter[:-1] & other[1:]
    wide = np.flatnonzero((texts[:-2] >= 0xC2) & (texts[:-2] < 0xE0) & (texts[1:-1] >= 128) & other[2:]) + 2
    cut[wide[_LETTER_2[(texts[wide - 2].astype(np.int64) & 31) << 6 | texts[wide - 1] & 63]]] = True
    return cut | edge


def _bytes_of(words: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all words, one after the other, and where each begins, and the last ends, in them."""
    words = words.cast(pa.large_binary())
    places = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    size = int(places[-1] - places[0])
    data = words.buffers()[2].slice(int(places[0]), size).to_pybytes() if size else b""
    return data, places - places[0]


def _lists(counts: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


class Encoder:
    """The library's encoding, asked once for each word met lately; ids are 32-bit numbers, one after the other."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        rule = self.library.pre_tokenizer
        # Where words end is known of this rule; a vocabulary of another one gets its texts whole.
        self.cuts = isinstance(rule, ByteLevel) and rule.use_regex and not rule.add_prefix_space and self.library.normalizer is None
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # The vocabulary writes each byte as one character.
        self.bytes = np.zeros(1 + max(self.library.get_vocab(with_added_tokens=True).values()), dtype=np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(token)
        self.words = pa.array([], pa.binary())
        self.ids = pa.array([], pa.list_(pa.int32()))

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(array("i", e.ids), dtype=np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each word, and the ids, for words that may follow each other in one text."""
        data, places = _bytes_of(words)
        text = data.decode()
        if not any(s in text for s in self.special):
            ids = self._library([text])[0]
            token_ends, ends = np.cumsum(self.bytes[ids]), places[1:]
            at = np.searchsorted(token_ends, ends)
            if len(ids) and at[-1] == len(ids) - 1 and (token_ends[at] == ends).all():
                return np.diff(at, prepend=-1), ids
        return self._single(words)

    def _single(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self._library([w.decode() for w in words.to_pylist()])
        return np.array([len(i) for i in ids], dtype=np.int64), np.concatenate([*ids, np.zeros(0, dtype=np.int32)])

    def _encode_words(self, words: pa.Array) -> pa.ListArray:
        """The ids of words from the library. Those that begin with a space and no more white space go there in one text."""
        sizes = pc.binary_length(words).to_numpy()
        data, places = _bytes_of(words)
        data, starts = np.frombuffer(data + PAD, dtype=np.uint8), places[:-1]
        joins = self.cuts & (sizes > 1) & (sizes <= LONG) & (data[starts] == 32) & _begins_word(data, starts)
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        listed, n = words.take(pa.array(order)), int(joins.sum())
        blocks = np.cumsum(sizes[order], dtype=np.int64) // JOINED
        marks = np.union1d(np.flatnonzero(np.diff(blocks)) + 1, [0, n, len(listed)])
        counts, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
        for a, b in zip(marks[:-1], marks[1:]):
            found = (self._joined if a < n else self._single)(listed[a:b])
            counts.append(found[0])
            ids.append(found[1])
        return _lists(np.concatenate(counts), np.concatenate(ids)).take(pa.array(np.argsort(order)))

    def encode(self, texts: pa.Array, end: int) -> pa.ListArray:
        """The ids of each text, with ``end`` after them."""
        data, places = _bytes_of(texts)
        data = np.frombuffer(data + PAD, dtype=np.uint8)
        if self.cuts:
            cut = _cuts(data, places)
        else:
            cut = np.zeros(places[-1] + 1, dtype=bool)
            cut[places] = True
        # A text that holds the name of a special token is cut differently, so the library takes it whole.
        for special in self.special:
            for k in np.flatnonzero(pc.match_substring(texts.cast(pa.binary()), special).to_numpy(zero_copy_only=False)):
                cut[places[k] + 1 : places[k + 1]] = False
        bounds = np.flatnonzero(cut).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        words = pieces.dictionary
        slot = pc.index_in(words, value_set=self.words)
        new = words.filter(slot.is_null())
        new_ids = self._encode_words(new)
        slots = slot.fill_null(0).to_numpy().copy()
        slots[slot.is_null().to_numpy(zero_copy_only=False)] = np.arange(len(new)) + len(self.words)
        ids = pa.concat_arrays([self.ids, new_ids, pa.array([[end]], pa.list_(pa.int32()))])
        row_of = np.searchsorted(bounds, places)
        rows = np.insert(slots[pieces.indices.to_numpy()], row_of[1:], len(ids) - 1)
        flat = ids.take(pa.array(rows))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(flat).to_numpy())])
        self._keep(new, new_ids)
        return _lists(np.diff(ends[row_of + np.arange(len(row_of))]), flat.flatten())

    def _keep(self, new: pa.Array, new_ids: pa.ListArray) -> None:
        short = pc.less_equal(pc.binary_length(new), LONG)
        kept = slice(None)
        if len(self.words) > CACHE_WORDS:  # frequent words are met first, so the older half is kept
            kept = slice(0, CACHE_WORDS // 2)
        self.words = pa.concat_arrays([self.words[kept], new.filter(short)])
        self.ids = pa.concat_arrays([self.ids[kept], new_ids.filter(short)])


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, read once in each Python process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
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


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end: int = END) -> None:
    """Encodes each row's whole text, appends ``end``, and stores the ids at ``path`` in order of the document ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            for a, b in _groups(pc.binary_length(batch.column(2)).to_pylist()):
                part = batch.slice(a, b - a)
                tokens = known.encode(part.column(2), end)
                columns = [part.column(0), part.column(1), pc.list_value_length(tokens).cast(pa.int64()), tokens]
                yield pa.record_batch(columns, names=["doc_id", "text_key", "n_tokens", "tokens"])

    rows = numbered_text(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = rows.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", "text")
    writer = rows.mapInArrow(run, SCHEMA).write.option("compression", "zstd")
    settings = {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "parquet.block.size": str(ROW_GROUP),
        "parquet.page.size": str(PAGE),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
    }
    for key, value in settings.items():
        writer = writer.option(key, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text_key, n_tokens, tokens and the ``file`` each row lies in; filters and columns reach the scan."""
    return spark.read.schema(SCHEMA).parquet(path).withColumn("file", F.col("_metadata.file_name"))


def with_starts(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rows`` (file, doc_id, text_key, n_tokens and more) with ``start``, the number of stored ids before a row."""
    totals = tokens.groupBy("file").agg(F.sum("n_tokens").alias("total")).orderBy("file").collect()
    spark, before, offsets = rows.sparkSession, 0, []
    for row in totals:  # one number a file
        offsets.append((row["file"], before))
        before += row["total"]
    bases = spark.createDataFrame(offsets, "file string, base long")
    inside = Window.partitionBy("file").orderBy("doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.join(bases, "file").withColumn("start", start).drop("base")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(4)
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        cuts = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        sums = pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], type=pa.int64())
        yield pa.record_batch([*batch.columns[:4], sums], names=["file", "doc_id", "text_key", "n_tokens", "ids_crc32"])


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit numbers) of every stored row."""
    rows = tokens.select("file", "doc_id", "text_key", "n_tokens", "tokens")
    summed = rows.mapInArrow(_checksums, "file string, doc_id long, text_key long, n_tokens long, ids_crc32 long")
    return with_starts(summed, tokens).select("doc_id", "start", "n_tokens", "ids_crc32")
