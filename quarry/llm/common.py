"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

# A-Z to a-z, byte by byte; every other byte (also inside UTF-8 sequences) stays.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: it is
    computed once, and a lost executor costs no recomputation upstream."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = 2000
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Settings that every operator here needs, made before its functions are
    sent to Python workers.

    Workers that have no copy of this package import the driver's, where they
    can see it (on a cluster, ship it as with any job). Arrow batches hold
    ARROW_ROWS rows where the session has Spark's default of 10,000: a row
    here is a whole text, and a batch is held by the JVM and by the Python
    worker at once."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    if spark.conf.get(_ARROW_KEY) == "10000":
        spark.conf.set(_ARROW_KEY, str(ARROW_ROWS))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column's decimal text, modulo n (the fold of a row)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    if data is None or n == 0 or off[-1] == off[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply), elementwise."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOWER_BYTES = np.frombuffer(LOWER, np.uint8)


def byte_terms(data: np.ndarray, place: np.ndarray, longest: int) -> np.ndarray:
    """Terms of the 64-bit polynomial hash of byte strings: the string's hash
    is their sum. ``place``: position of each byte in its string."""
    powers = np.cumprod(np.full(max(longest, 1), 0x9E3779B97F4A7C55, np.uint64))
    term = powers[place]
    term *= _BYTE[data]
    return term


def string_hashes(
    data: np.ndarray, at: np.ndarray, lens: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the strings of ``data`` that begin at
    ``at`` and follow each other."""
    place = np.arange(len(data), dtype=np.int32)
    place -= np.repeat(at.astype(np.int32), lens)
    term = byte_terms(data, place, int(lens.max()))
    del place
    key = mix(np.add.reduceat(term, at) + lens.astype(np.uint64))
    term ^= term >> _U(29)
    term *= _U(0xD6E8FEB86659FD93)
    return key, np.add.reduceat(term, at)


class Words:
    """The words of a batch of texts: ``which`` distinct word each occurrence
    is, the word offsets of the texts, and hashes and bytes of the distinct."""

    def __init__(self, data, solid, first, offsets):
        """``solid``: bytes in a word; ``first``: bytes that start one."""
        starts = np.flatnonzero(first)
        self.offsets = np.searchsorted(starts, offsets)
        self.which = np.empty(0, np.int64)
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self._bytes, self._at, self._lens = data, self.which, self.which
        if not len(starts):
            return
        kept = data[solid]
        at = np.cumsum(solid, dtype=np.int32)[starts].astype(np.int64) - 1
        lens = np.diff(np.append(at, len(kept)))
        key, check = string_hashes(kept, at, lens)
        self.which, found = pd.factorize(key)
        one = np.empty(len(found), np.int64)
        one[self.which[::-1]] = np.arange(len(key))[::-1]
        if not (check == check[one][self.which]).all():
            raise ValueError("two words share a 64-bit hash")
        self.key, self.check = key[one], check[one]
        self._bytes, self._at, self._lens = kept, at[one], lens[one]

    def strings(self, chosen: np.ndarray) -> pa.Array:
        """The chosen distinct words, as an Arrow string array."""
        n = self._lens[chosen]
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        inside = np.arange(int(ends[-1])) - np.repeat(ends[:-1].astype(np.int64), n)
        chars = self._bytes[np.repeat(self._at[chosen], n) + inside]
        return pa.Array.from_buffers(
            pa.string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(chars)]
        )


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes in a word, bytes that start one): words end at ASCII white space
    and at the end of a text."""
    solid = ~_WHITE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = solid[at]
    return solid, first


_WORD_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)  # the first n bytes
_SPACES = _U(0x2020202020202020)
_ROUNDS = 8  # longer words than this many times 8 bytes are hashed byte by byte


def _taken(data: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The strings of ``data`` that begin at ``at``, one after another."""
    ends = np.cumsum(lens)
    inside = np.arange(int(ends[-1]) if len(ends) else 0)
    return data[np.repeat(at - ends + lens, lens) + inside]


class _LowerWords(Words):
    """The same for words between ASCII white space. Words are told apart 8
    bytes at a time, and only the distinct are hashed byte by byte."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        eights = np.full(n // 8 + 2, _SPACES, "<u8")
        low = eights.view(np.uint8)
        low[:n] = data
        solid = (low[:n] != 32) & (low[:n] - np.uint8(9) > 4)
        # A-Z in every byte at once: the top bit of each tells
        ascii_bits = eights & _U(0x7F7F7F7F7F7F7F7F)
        upper = (ascii_bits + _U(0x3F3F3F3F3F3F3F3F)) & ~(ascii_bits + _U(0x2525252525252525))
        upper &= ~eights & _U(0x8080808080808080)
        eights |= upper >> _U(2)
        every = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))  # from every byte on
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        at = offsets[:-1][offsets[:-1] < n]
        first[at] = solid[at]
        starts = np.flatnonzero(first)
        self.offsets = np.searchsorted(starts, offsets)
        self.which = np.empty(0, np.int64)
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self._bytes, self._at, self._lens = low, self.which, self.which
        if not len(starts):
            return
        last = solid.copy()
        last[:-1] &= ~solid[1:] | first[1:]
        lens = np.flatnonzero(last) + 1 - starts

        def eight(at, lens):
            """Eight bytes from ``at``, with spaces for those after ``lens``."""
            mask = _WORD_MASK[np.minimum(lens, 8)]
            return (every[at] & mask) | (_SPACES & ~mask)

        one = eight(starts, lens)  # the word itself, if no longer: no word has a space
        two = lens.astype(_U)
        some = np.flatnonzero(lens > 8)
        for i in range(1, _ROUNDS):
            some = some[lens[some] > 8 * i]
            if not len(some):
                break
            more = eight(starts[some] + 8 * i, lens[some] - 8 * i)
            one[some] = mix(one[some] + _U(i)) + more
            two[some] = mix(two[some] ^ more)
        some = some[lens[some] > 8 * _ROUNDS]
        if len(some):
            n_bytes = lens[some]
            one[some], two[some] = string_hashes(
                _taken(low, starts[some], n_bytes), np.cumsum(n_bytes) - n_bytes, n_bytes)
        self.which, found = pd.factorize(one, size_hint=len(one) // 4)
        top = np.maximum.accumulate(self.which)  # distinct words are numbered as they come
        new = np.flatnonzero(np.diff(top, prepend=-1))
        same = (two[new][self.which] == two) & (lens[new][self.which] == lens)
        self._lens = lens[new]
        self._at = np.cumsum(self._lens) - self._lens
        self._bytes = _taken(low, starts[new], self._lens)
        self.key, self.check = string_hashes(self._bytes, self._at, self._lens)
        keys = np.sort(self.key)
        if not same.all() or (keys[1:] == keys[:-1]).any():
            raise ValueError("two words share a 64-bit hash")


def lower_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of a batch, A-Z lower-cased."""
    return _LowerWords(data, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of every text, in order, A-Z lower-cased,
    and the word offsets of the texts (length: texts + 1)."""
    solid, first = _word_starts(data, offsets)
    starts = np.flatnonzero(first)
    woff = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), woff
    kept = _LOWER_BYTES[data[solid]]
    at = np.cumsum(solid, dtype=np.int32)[starts].astype(np.int64) - 1
    lens = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept), dtype=np.int32)
    place -= np.repeat(at.astype(np.int32), lens)
    term = byte_terms(kept, place, int(lens.max()))
    return mix(np.add.reduceat(term, at) + lens.astype(np.uint64)), woff


def frequent_from(table: DataFrame, size: Column, most: int, most_bytes: int) -> int | None:
    """The least count ``n`` from which on the rows of ``table`` number at most
    ``most`` and take at most ``most_bytes`` (by ``size``); None if there is
    none. Counts are looked at in steps of a sixteenth of a power of two."""
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    steps = table.groupBy(step).agg(
        F.count("*").alias("rows"), F.sum(size).alias("bytes"), F.min("n").alias("least")
    ).collect()  # at most 16 rows a power of two
    rows = total = 0
    least = None
    for r in sorted(steps, key=lambda r: -r.step):
        rows, total = rows + r["rows"], total + r["bytes"]
        if rows > most or total > most_bytes:
            break
        least = r["least"]
    return least


def shingles(
    words: np.ndarray, woff: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the k-word shingles of every text, in order and with
    repeats, and their offsets. A text of 1 to k-1 words has one shingle, its
    whole sequence; a text without words has none."""
    n = np.diff(woff)
    soff = np.concatenate([[0], np.cumsum(np.where(n >= k, n - k + 1, np.minimum(n, 1)))])
    out = np.empty(int(soff[-1]), np.uint64)
    if not len(out):
        return out, soff
    place = np.arange(len(out)) - np.repeat(soff[:-1], np.diff(soff))
    at = place + np.repeat(woff[:-1], np.diff(soff))
    many = np.repeat(n >= k, np.diff(soff))
    h = np.zeros(len(out), np.uint64)
    sizes = np.repeat(n, np.diff(soff))
    for j in range(k):
        has = many | (j < sizes)
        h = np.where(has, mix(h + _U(j + 1)) + words[np.minimum(at + j, len(words) - 1)], h)
    return mix(h + np.minimum(sizes, k).astype(np.uint64)), soff


def byte_batches(items, size, most: int):
    """Groups of consecutive items of about ``most`` bytes (one larger item
    makes a group of its own)."""
    group, total = [], 0
    for item in items:
        n = size(item)
        if group and total + n > most:
            yield group
            group, total = [], 0
        group.append(item)
        total += n
    if group:
        yield group


def sliced(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Slices of an Arrow batch of about ``most`` text bytes."""
    _, off = text_buffers(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield batch.slice(lo, hi - lo)
        lo = hi
