"""BPE encoding and decoding through a table of distinct words.

Encoding:

1. Texts are split into the tokenizer's own words: runs of letters, of other
   signs, and single digits, lower-cased; a word with odd characters stays
   whole (see :mod:`quarry.llm.tokens`).
2. The distinct words of the corpus, with their counts, form a table, and each
   of them is encoded once.
3. Ids go back to the words by position. The most frequent words, at most
   HEAD_WORDS of them and HEAD_BYTES in total, are a broadcast table. The
   others meet their occurrences in a join on the word; a word outside the
   broadcast table has a small share of all words, so no key of that join is
   hot. Texts travel as compressed arrays of word numbers, and every text
   meets the ids of its rare words in one shuffle by document. A document is
   told by 96 bits of two hashes of its id and text; a place in it takes the
   other 31 bits of the two numbers. Ids take two bytes where the vocabulary
   allows.

Decoding looks the piece of each id up in the vocabulary (a bounded table) and
joins the pieces with spaces, as the library does for a file without decoder.

Defined results: null text counts as empty and has no ids; rows with equal id
and text are kept, each; null ids are kept. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens
from quarry.llm.common import (
    Words, frequent_from, saved, sliced, prepare, string_hashes, text_buffers,
)

HEAD_WORDS = 2_000_000
HEAD_BYTES = 48 << 20
SLICE_BYTES = 2 << 20  # text bytes split at once
_PLACE = (1 << 32) - 1  # the lower half of a place
_TEXT = 1 << 31  # there: the text itself, after its words


def token_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of a batch as the tokenizer splits them, lower-cased."""
    heads = offsets[:-1][offsets[:-1] < len(data)]
    if not len(data):
        return Words(data, np.zeros(0, bool), np.zeros(0, bool), offsets)
    kind, low, first = tokens.run_starts(data, heads)
    return Words(low, kind != tokens.SPACE, first, offsets)


class Head:
    """Broadcast ids of the frequent words. Word numbers start at 1; 0 is a
    word that is not here."""

    def __init__(self, key, check, ids, counts):
        order = np.argsort(key)
        self.key, self.check = key[order], check[order].astype(np.uint32)  # 96 bits in all
        self.number = (order + 1).astype(np.int32)
        self.begin = np.concatenate([[0, 0], np.cumsum(counts)]).astype(np.int32)
        self.ids = ids

    def numbers(self, words: Words) -> np.ndarray:
        """Word number of each distinct word."""
        if not len(self.key):
            return np.zeros(len(words.key), np.int32)
        at = np.minimum(np.searchsorted(self.key, words.key), len(self.key) - 1)
        same = (self.key[at] == words.key) & (self.check[at] == words.check.astype(np.uint32))
        return np.where(same, self.number[at], 0).astype(np.int32)

    def text_ids(self, numbers: np.ndarray, rare: list[bytes]) -> np.ndarray:
        """Ids of a text from its word numbers and the packed ids of its words
        numbered 0, in order."""
        begin = self.begin[numbers].astype(np.int64)
        counts = self.begin[numbers + 1] - begin
        missing = numbers == 0
        if missing.sum() != len(rare):
            raise ValueError("ids of rare words are missing")
        width = self.ids.dtype.itemsize
        counts[missing] = [len(r) // width for r in rare]
        total = int(counts.sum())
        first = np.cumsum(counts) - counts
        out = np.empty(total, self.ids.dtype)
        known = np.repeat(~missing, counts)
        source = np.repeat(begin - first, counts) + np.arange(total)
        out[known] = self.ids[source[known]]
        out[~known] = np.frombuffer(b"".join(rare), self.ids.dtype)
        return out


def _id_type(path: str) -> str:
    """The number type of packed ids of this tokenizer."""
    most = max(tokens.load(path).get_vocab(with_added_tokens=True).values())
    return "<u2" if most < 1 << 16 else "<u4"


def _packed_ids(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Ids as bytes, ``counts`` of them a row."""
    ends = np.concatenate([[0], np.cumsum(counts * ids.dtype.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())])


def _narrowed(kind: str):
    """Arrow function: (word, ids) with ids of the number type ``kind``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(1).to_pylist()
            ids = np.frombuffer(b"".join(packed), "<u4").astype(kind)
            counts = np.array([len(p) // 4 for p in packed], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _packed_ids(ids, counts)], names=["word", "ids"])

    return run


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """(word, n, ids): every distinct word of the texts, its count and its
    packed ids; written once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                w = token_words(*text_buffers(part.column(0)))
                every = np.arange(len(w.key))
                yield pa.RecordBatch.from_arrays(
                    [w.strings(every), pa.array(np.bincount(w.which, minlength=len(every)))],
                    names=["word", "n"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffers(batch.column(0))
            ids, k = tokens.encode_texts(path, data, off)
            packed = _packed_ids(ids.astype("<u4"), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), packed], names=["word", "n", "ids"]
            )

    words = docs.select("text").mapInArrow(counted, "word string, n bigint")
    distinct = words.groupBy("word").agg(F.sum("n").alias("n"))
    return saved(distinct.mapInArrow(encoded, "word string, n bigint, ids binary"), "bpe-words")


def _head(table: DataFrame, kind: str) -> tuple[int, Head]:
    """(count from which on a word is in the head, the head)."""
    size = F.octet_length("word") + F.octet_length("ids")
    least = frequent_from(table, size, HEAD_WORDS, HEAD_BYTES)
    if least is None:
        return 1 << 62, Head(np.empty(0, np.uint64), np.empty(0, np.uint64),
                             np.empty(0, kind), np.empty(0, np.int64))
    rows = table.where(F.col("n") >= least).toArrow()  # bounded by HEAD_WORDS, HEAD_BYTES
    rows = rows.sort_by([("n", "descending")]).combine_chunks()  # small numbers for many words
    data, off = text_buffers(rows.column("word"))
    key, check = string_hashes(data, off[:-1], np.diff(off))
    packed = rows.column("ids").to_pylist()
    ids = np.frombuffer(b"".join(packed), "<u4").astype(kind)
    return least, Head(key, check, ids, np.array([len(p) // 4 for p in packed]))


def _packed_numbers(numbers: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The word numbers of every text, compressed: seven bits to a byte, so
    that frequent words take one or two."""
    x = numbers.astype(np.int64)
    size = 1 + (x >= 1 << 7) + (x >= 1 << 14) + (x >= 1 << 21) + (x >= 1 << 28)
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = np.empty(int(ends[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        more = np.where(size[has] > k + 1, 128, 0)
        flat[ends[:-1][has] + k] = (x[has] >> (7 * k)) & 127 | more
    raw, cuts = flat.tobytes(), ends[offsets]
    zip_one = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
    return [zip_one(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    last = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)
    if not len(last):
        return np.empty(0, np.int64)
    place = np.arange(len(raw)) - np.repeat(starts, last + 1 - starts)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row: the library's ids of the whole
    text, without special tokens of its own."""
    prepare(docs.sparkSession)
    few = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    table = word_table(few, path)
    kind = _id_type(path)
    least, found = _head(table, kind)
    shared = few.sparkSession.sparkContext.broadcast(found)
    # equal id and text have equal ids, so they may share a key: h and the upper
    # half of a place, of which the lower half is the word's position
    second = F.xxhash64(F.lit(1), "doc_id", "text")
    keyed = few.select("doc_id", F.xxhash64("doc_id", "text").alias("h"),
                       F.shiftleft(F.shiftright(second, 32), 32).alias("at"), "text")

    def parts(batches):
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                w = token_words(*text_buffers(part.column(3)))
                yield part, w, shared.value.numbers(w)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, number in parts(batches):
            at = np.flatnonzero(number[w.which] == 0)
            row = np.searchsorted(w.offsets, at, side="right") - 1
            own = part.column(2).to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [w.strings(w.which[at]), part.column(1).take(pa.array(row)),
                 pa.array(own + (at - w.offsets[row]))],
                names=["word", "h", "at"],
            )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, number in parts(batches):
            rows = _packed_numbers(number[w.which], w.offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(part.column(2).to_numpy() + _TEXT),
                 pa.array(rows, pa.binary())],
                names=["doc_id", "h", "at", "payload"],
            )

    occurrences = keyed.mapInArrow(rare, "word string, h bigint, at bigint")
    others = table.where(F.col("n") < least).select("word", "ids").mapInArrow(
        _narrowed(kind), "word string, ids binary")
    answers = occurrences.join(others, "word")
    both = answers.select(
        F.lit(None).cast("bigint").alias("doc_id"), "h", "at", F.col("ids").alias("payload")
    ).unionByName(keyed.mapInArrow(numbered, "doc_id bigint, h bigint, at bigint, payload binary"))
    # per document: its rare words by position, then its rows
    met = both.repartition("h").sortWithinPartitions("h", "at")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, rares = None, -1, []
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, h, at, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if (h, at >> 32) != now:
                    now, last, rares = (h, at >> 32), -1, []
                if at & _PLACE < _TEXT:
                    if at != last:  # rows of equal id and text repeat their words
                        rares.append(payload)
                        last = at
                    continue
                ids.append(doc)
                texts.append(shared.value.text_ids(_numbers(payload), rares))
                size += len(texts[-1])
                if size > 1 << 20:
                    yield _id_batch(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield _id_batch(ids, texts)

    return met.mapInArrow(gathered, "doc_id bigint, ids array<int>")


def _id_batch(ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int32)
    flat = pa.array(np.concatenate(texts).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)],
        names=["doc_id", "ids"],
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of its ``ids`` as the
    library gives it, special tokens kept. Null ids decode to null."""
    prepare(encoded.sparkSession)
    kept = [c for c in encoded.columns if c not in ("ids", "decoded")]
    types = dict(encoded.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tokens.load(path).get_vocab(with_added_tokens=True)
        piece = [""] * (max(vocabulary.values()) + 1)
        for text, i in vocabulary.items():
            piece[i] = text
        pieces = pa.array(piece, pa.string())
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = part.column(at)
                flat = pieces.take(ids.flatten())
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
                joined = pc.if_else(ids.is_valid(), pc.binary_join(lists, " "), None)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, joined], names=[*part.schema.names, "decoded"]
                )

    fields = ", ".join(f"`{c}` {types[c]}" for c in [*kept, "ids"])
    return encoded.select(*kept, "ids").mapInArrow(run, f"{fields}, decoded string")
