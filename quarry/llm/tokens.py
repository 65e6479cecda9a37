"""Token counts and token ids of whole texts with a public tokenizer file.

The tokenizer of ``word_bpe_49k.json`` drops white space before its pieces
are formed and recognises its special strings, which hold no white space, in
the raw text. So a text may be cut at any run of ASCII white space: the ids
of the text are the ids of its words in order. Texts go
to the encoder in batches of about CHUNK_BYTES that end at white space,
whatever the lengths of the texts, and each distinct word part of a batch is
encoded once.
``.model`` files keep white space, so their texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, byte_batches, byte_terms, mix, prepare, text_buffers

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_loaded: dict = {}


def load(path: str):
    """The tokenizer of ``path``, without truncation and padding; loaded once
    per Python worker."""
    if path not in _loaded:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _loaded[path] = t
    return _loaded[path]


# Byte classes. A word of printable ASCII and Latin-1 letters, without an
# apostrophe (contractions) and without the start of a special string, is only
# lower-cased by the normaliser, and its runs of one class (digits one by one)
# are the pieces of the tokenizer's own pattern: they may go straight to its
# BPE model. Any other word is "odd" and goes to the whole tokenizer.
SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _ODD
_LEAD = 0xC3  # first byte of U+00C0..U+00FF
_LOWER = np.frombuffer(LOWER, np.uint8)

CHUNK_BYTES = 4 << 20  # text bytes handled at once
RUNS_PER_TEXT = 2000
_APART = "\x01"  # stands alone between odd words in one text


class _Model:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.whole = load(path)
        self.by_run = Tokenizer(self.whole.model)
        self.by_run.pre_tokenizer = WhitespaceSplit()
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        chars = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100))]
        self.table = str.maketrans({c: as_bytes.pre_tokenize_str(c)[0][0] for c in chars})
        vocabulary = self.by_run.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # a run ends with such a token
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.mark = self.whole.encode(_APART, add_special_tokens=False).ids
        if len(self.mark) != 1:
            raise ValueError("the separator must be one token")

    def encode_runs(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and token counts of the runs of ``data``, one space after each;
        ``ends``: the byte after each run's space."""
        cuts = [0, *ends[RUNS_PER_TEXT - 1::RUNS_PER_TEXT].tolist(), len(data)]
        texts = [data[a:b].decode().translate(self.table) for a, b in zip(cuts, cuts[1:]) if a < b]
        encoded = self.by_run.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        at = np.flatnonzero(self.last[ids]) + 1
        if len(at) != len(ends):
            raise ValueError("the vocabulary does not mark the ends of runs")
        return ids, np.diff(at, prepend=0)

    def encode_odd(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and token counts of odd words, many to a text."""
        out: list = [None] * len(words)
        many = []
        for i, w in enumerate(words):
            if b"\x01" in w or len(w) > CHUNK_BYTES:
                e = self.whole.encode(w.decode(), add_special_tokens=False)
                out[i] = np.array(e.ids, np.uint32)
            else:
                many.append(i)
        for group in byte_batches(many, lambda i: len(words[i]) + 3, 1 << 16):
            text = f" {_APART} ".join(words[i].decode() for i in group)
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark[0]).tolist()
            for i, lo, hi in zip(group, [-1, *cuts], [*cuts, len(ids)], strict=True):
                out[i] = ids[lo + 1:hi]
        return np.concatenate(out), np.array([len(x) for x in out])


_models: dict = {}


def _model(path: str) -> _Model:
    if path not in _models:
        _models[path] = _Model(path)
    return _models[path]


def classes(data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes, lower-cased bytes (odd words as they are), and where
    words start; ``heads``: where texts start."""
    kind, low = _CLASS[data], _LOWER[data]
    after = np.empty(len(data), bool)
    after[0], after[1:] = False, data[:-1] == _LEAD
    high = np.flatnonzero(after)
    if len(high):
        kind[high] = kind[high - 1] = _LETTER
        b = data[high]
        bad = high[(b == 0x97) | (b == 0xB7)]  # the signs among the letters
        kind[bad] = _ODD
        low[high] = np.where((b < 0x9F) & (b != 0x97), b + 0x20, b)
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    kind[special] = _ODD
    solid = kind != SPACE
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[heads] = solid[heads]
    odd = np.flatnonzero(kind == _ODD)
    if len(odd):
        starts = np.flatnonzero(first)
        words = np.unique(np.searchsorted(starts, odd, side="right") - 1)
        ends = np.append(starts, len(data))[words + 1]
        for a, b in zip(starts[words].tolist(), ends.tolist()):
            part = solid[a:b]
            kind[a:b][part] = _ODD
            low[a:b] = data[a:b]
    return kind, low, first


def run_starts(
    data: np.ndarray, heads: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte classes, lower-cased bytes, where runs start): a run is a piece
    of a plain word, or a whole odd word. No run is both."""
    kind, low, first = classes(data, heads)
    first[1:] |= (kind[1:] != SPACE) & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    return kind, low, first


def _encode_chunk(model: _Model, data: np.ndarray, heads: np.ndarray):
    """(where runs start, token count per run, ids of the distinct runs, where
    each run's ids begin in them) of one chunk."""
    kind, low, first = run_starts(data, heads)
    solid = kind != SPACE
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64)
    at = np.cumsum(solid, dtype=np.int32)[starts] - 1
    kept = low[solid]
    lens = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept), dtype=np.int32) - np.repeat(at, lens)
    term = byte_terms(kept, place, int(lens.max()))
    odd = kind[starts] == _ODD
    key = mix(np.add.reduceat(term, at) + odd.astype(np.uint64))
    check = np.add.reduceat((term ^ (term >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93), at)
    codes, found = pd.factorize(key)
    one = np.empty(len(found), np.int64)
    one[codes[::-1]] = np.arange(len(codes))[::-1]
    if not (check == check[one][codes]).all():
        raise ValueError("two runs share a 64-bit hash")
    counts, begin, pool, size = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64), [], 0
    plain = np.flatnonzero(~odd[one])
    if len(plain):
        n = lens[one[plain]]
        ends = np.cumsum(n + 1)
        joined = np.full(int(ends[-1]), 32, np.uint8)
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        joined[np.repeat(ends - n - 1, n) + inside] = kept[np.repeat(at[one[plain]], n) + inside]
        ids, k = model.encode_runs(joined.tobytes(), ends)
        counts[plain], begin[plain] = k, np.cumsum(k) - k
        pool, size = [ids], len(ids)
    others = np.flatnonzero(odd[one])
    if len(others):
        words = [kept[a:a + n].tobytes() for a, n in zip(at[one[others]], lens[one[others]])]
        ids, k = model.encode_odd(words)
        counts[others], begin[others] = k, size + np.cumsum(k) - k
        pool.append(ids)
    return starts, counts[codes], np.concatenate(pool), begin[codes]


def _chunks(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``most`` bytes that end at white space or at the
    end of a text; a longer run without either stays whole."""
    lo = 0
    while lo < len(data):
        hi = min(lo + most, len(data))
        if hi < len(data):
            text_end = int(offsets[np.searchsorted(offsets, hi, side="right") - 1])
            white = np.flatnonzero(_CLASS[data[max(lo, text_end):hi]] == SPACE)
            best = max(text_end, max(lo, text_end) + int(white[-1]) + 1 if len(white) else 0)
            while best <= lo:  # nothing in reach: on to the next break
                end = int(offsets[np.searchsorted(offsets, hi, side="left")])
                stop = min(hi + most, end)
                white = np.flatnonzero(_CLASS[data[hi:stop]] == SPACE)
                best = hi + int(white[0]) + 1 if len(white) else (end if stop == end else lo)
                hi = stop
            hi = best
        yield lo, hi
        lo = hi


def encode_texts(
    path: str, data: np.ndarray, offsets: np.ndarray, ids: bool = True, most: int = CHUNK_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """(token ids of all texts in order, token count of each text); without
    ``ids`` the first is empty."""
    n = len(offsets) - 1
    counts, flat = np.zeros(n, np.int64), []
    model = _model(path)
    for lo, hi in _chunks(data, offsets, most):
        a, b = np.searchsorted(offsets, [lo, hi], side="right")
        heads = offsets[a:b]
        heads = heads[heads < hi] - lo
        starts, k, pool, begin = _encode_chunk(model, data[lo:hi], heads)
        total = np.concatenate([[0], np.cumsum(k)])
        inside = np.clip(offsets - lo, 0, hi - lo)
        counts += np.diff(total[np.searchsorted(starts, inside)])
        if ids and total[-1]:
            flat.append(pool[np.repeat(begin - total[:-1], k) + np.arange(total[-1])])
    return (np.concatenate(flat) if flat else np.empty(0, np.uint32)), counts


def _count_model(path: str, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if path not in _loaded:
        import sentencepiece

        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = (data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:]))
    counts: list[int] = []
    for group in byte_batches(texts, len, CHUNK_BYTES):
        counts += map(len, _loaded[path].encode(group, num_threads=1))
    return np.array(counts, np.int64)


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids
    are kept as they are; an empty table gives an empty result; other columns
    are not read. No special tokens are added; special strings in a text are
    recognised as the tokenizer file says. ``over_limit``: n_tokens > limit.
    """
    prepare(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            if path.endswith(".model"):
                n = _count_model(path, data, off)
            else:
                n = encode_texts(path, data, off, ids=False)[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    few = docs.select(F.col(id_column), F.col(text_column))
    kind = dict(few.dtypes)[id_column]
    return few.mapInArrow(
        run, f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
