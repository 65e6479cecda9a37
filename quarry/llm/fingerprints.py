"""Document fingerprints by one-permutation MinHash.

Every shingle (five words, A-Z lower-cased) is hashed once; the top bits of
the hash choose one of BINS bins, and a bin keeps its smallest hash. An empty
bin borrows from another chosen by a hash of the bin and the attempt (optimal
densification). Of each bin the low-order BITS bits are stored. Two
fingerprints of likeness J agree in about J + (1 - J) / 2**BITS of the bins;
:func:`likeness` corrects this and is about J.

Defined results: null text counts as empty; texts without words share the
all-zero fingerprint of their own, alike to each other (1.0) and unlike any
text with words (0.0); a text of 1 to 4 words has one shingle, its whole
sequence. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix, saved, shingles, prepare, text_buffers, word_hashes

BINS = 256
BITS = 4
WORDS = 5
ROWS = 2048  # texts whose bins are held at once
KEY_CHARS = 32  # of a text, to deal the rows of one id into ranges
BYTES = 4 << 20  # text bytes handled at once

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_PROBES = 4096


def _probe_table() -> np.ndarray:
    """(attempt, bin) -> bin to borrow from."""
    n = np.arange(_PROBES * BINS, dtype=np.uint64) + np.uint64(0x51ED270B)
    return (mix(n) % np.uint64(BINS)).astype(np.int64).reshape(_PROBES, BINS)


_PROBE = _probe_table()
_SALT = mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def densified(bins: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has a filled one."""
    filled = bins != _EMPTY
    out = bins.copy()
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for attempt in range(_PROBES):
        if not len(row):
            return out
        source = _PROBE[attempt][col]
        ok = filled[row, source]
        out[row[ok], col[ok]] = bins[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
    while len(row):  # next filled bin to the right
        source = (col + 1) % BINS
        step = np.ones(len(col), np.int64)
        while not filled[row, source].all():
            step += ~filled[row, source]
            source = (col + step) % BINS
        out[row, col] = bins[row, source]
        break
    return out


def sketches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BINS low-order bits, rows with words) of a batch of texts."""
    n = len(offsets) - 1
    bits, some = np.zeros((n, BINS), np.uint8), np.zeros(n, bool)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + ROWS, n)
        off = offsets[lo:hi + 1]
        h, at = shingles(*word_hashes(data[off[0]:off[-1]], off - off[0]), WORDS)
        row = np.repeat(np.arange(hi - lo), np.diff(at))
        bins = np.full((hi - lo) * BINS, _EMPTY)
        slot = row * BINS + (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        np.minimum.at(bins, slot, np.minimum(h, _EMPTY - np.uint64(1)))
        full = densified(bins.reshape(-1, BINS))
        some[lo:hi] = np.diff(at) > 0
        # salted by the bin, else all borrowers of a bin would agree by chance at once
        low = (mix(full + _SALT) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
        bits[lo:hi] = np.where(some[lo:hi, None], low, 0)
        lo = hi
    return bits, some


def packed(bits: np.ndarray, some: np.ndarray) -> list[bytes]:
    """One leading byte (1: has words), then two bins to a byte."""
    halves = (bits[:, 0::2] << 4) | bits[:, 1::2]
    rows = np.concatenate([some.astype(np.uint8)[:, None], halves], axis=1)
    return [r.tobytes() for r in rows]


def unpacked(prints: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)
    bits = np.empty((len(raw), BINS), np.uint8)
    bits[:, 0::2], bits[:, 1::2] = raw[:, 1:] >> 4, raw[:, 1:] & 15
    return bits, raw[:, 0] == 1


def likeness(a: np.ndarray, has_a: np.ndarray, b: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of the shingles, row by row, 0 to 1."""
    chance = 1.0 / (1 << BITS)
    same = (a == b).mean(axis=1)
    j = np.clip((same - chance) / (1 - chance), 0.0, 1.0)
    return np.where(has_a & has_b, j, (has_a == has_b).astype(float))


def fingerprints(docs: DataFrame, text_column: str = "text", name: str = "fingerprint"):
    """``docs`` with a hex column ``name``; an existing one is replaced."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]
    source = docs.select(*kept, F.col(text_column).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = packed(*sketches(*text_buffers(batch.column(len(kept)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([p.hex() for p in prints])], names=[*kept, name]
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)
    return source.mapInArrow(run, f"{fields}, `{name}` string")


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()),
    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_RESULT_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of the next."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return sketches(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def _compare(ids: list, texts: list[str], after: list[str]) -> list[pa.Array]:
    """Result columns of texts, each followed by ``after``."""
    changed = [edited(t, a) for t, a in zip(texts, after)]
    (a, has_a), (e, has_e) = _of(texts), _of(changed)
    # in a run each text is followed by the next of the list, so most are known
    if after[:-1] == texts[1:]:
        last, has_last = _of(after[-1:])
        b, has_b = np.concatenate([a[1:], last]), np.concatenate([has_a[1:], has_last])
    else:
        b, has_b = _of(after)
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c.encode()).digest() for c in changed], pa.binary()),
        pa.array(packed(a, has_a), pa.binary()), pa.array(packed(e, has_e), pa.binary()),
        pa.array(likeness(a, has_a, e, has_e)), pa.array(likeness(a, has_a, b, has_b)),
    ]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range of ids, in order. The first text and the last row of
    the range go out as they are, to be met with the neighbouring ranges."""
    task = TaskContext.get()
    pid = task.partitionId() if task else 0

    def out(columns, kind, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.int32()), pa.array([pid] * n, pa.int64()),
             pa.array(texts, pa.string()), *columns],
            names=["kind", "pid", "text", *_RESULT.names],
        )

    def bare(i, text, kind):
        columns = [pa.array([i], pa.int64()), *(pa.nulls(1, f.type) for f in list(_RESULT)[1:])]
        return out(columns, kind, [text])

    ids: list = []
    texts: list[str] = []
    size, begun = 0, False
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            t = t or ""
            if not begun:
                begun = True
                yield bare(i, t, 1)
            ids.append(i)
            texts.append(t)
            size += len(t)
            if len(texts) > 1 and (size > BYTES or len(texts) > ROWS):
                yield out(_compare(ids[:-1], texts[:-1], texts[1:]), 0, [None] * (len(ids) - 1))
                ids, texts, size = ids[-1:], texts[-1:], len(t)
    if len(texts) > 1:
        yield out(_compare(ids[:-1], texts[:-1], texts[1:]), 0, [None] * (len(ids) - 1))
    if begun:
        yield bare(ids[-1], texts[-1], 2)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (last quarter
    replaced by the start of the next document by doc_id; after the last comes
    the first), and its likeness to the edited and to the next text.

    Documents are dealt into ranges of doc_id and read in order; only the
    first and last document of each range meet another range. Null ids sort
    first; equal ids are ordered by text, and their rows are dealt by the
    first KEY_CHARS characters of it. Empty table: empty result. Other
    columns are not read.
    """
    prepare(docs.sparkSession)
    few = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    # the start of the text deals out the rows of one id, null ids above all
    start = F.substring("text", 1, KEY_CHARS)
    ranges = few.repartitionByRange("doc_id", start).sortWithinPartitions("doc_id", "text")
    parts = saved(
        ranges.mapInArrow(_in_order, f"kind int, pid bigint, text string, {_RESULT_DDL}"),
        "fingerprints",
    )
    edge = parts.where("kind > 0").select("kind", "pid", "doc_id", "text")
    # one row a range, at most the number of shuffle partitions
    pids = sorted(r.pid for r in edge.where("kind = 2").select("pid").collect())
    follows = docs.sparkSession.createDataFrame(
        list(zip(pids, pids[1:] + pids[:1])), "pid bigint, next_pid bigint"
    )
    firsts = edge.where("kind = 1").select(
        F.col("pid").alias("next_pid"), F.col("text").alias("after")
    )
    lasts = edge.where("kind = 2").join(follows, "pid").join(firsts, "next_pid")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, t, a = (batch.column(c)[k].as_py() for c in range(3))
                yield pa.RecordBatch.from_arrays(_compare([i], [t], [a]), schema=_RESULT)

    rest = lasts.select("doc_id", "text", "after").mapInArrow(across, _RESULT_DDL)
    whole = parts.where("kind = 0").select(*_RESULT.names).unionByName(rest)
    return whole.select(
        "doc_id", "n_chars",
        *(F.lower(F.hex(c)).alias(c)
          for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        "near_edited", "near_next",
    )
