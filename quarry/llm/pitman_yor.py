"""Language-model scores of texts by a hierarchical Pitman-Yor model.

Tokens are words (A-Z lower-cased) and one end token a text. The CLASSES most
frequent training words and the end are classes of their own; all other words
form the class RARE. The model is

    P(text) = product of P(word | word before).

Every word and the start of a text is a context with a restaurant of its own
for the pairs that touch a rare word; of two classes that are words, the class
is the word and no further restaurant is needed.

* ``P(class | before)``: one restaurant per preceding class (the text's start
  included), all sharing one parent restaurant over classes, whose base is
  uniform. Customers are the counts of class pairs in the training texts.
* ``P(word | RARE)``: one restaurant over all rare training words and the
  unknown word, with a uniform base.
* ``P(word | word before)`` after a rare word: a restaurant over all words with
  the base ``P(class | RARE)``, times ``P(word | RARE)`` for a rare word.
* The same after a frequent word or the start: ``P(class | before)``, times,
  for a rare word, a restaurant over the rare words that follow, with the base
  ``P(word | RARE)``.

Pairs that touch a rare word are packed with their texts, dealt to parts by
the word before, and settled there in one sorted pass: counted, seated, and
added up by text. The pairs of contexts of many customers (WIDE) are dealt by
both words, and their tables are summed over the tasks. The restaurants of
classes and of rare words are seated first and are the given parents.

Seating follows the Chinese restaurant process and is sampled by Gibbs sweeps:
in a sweep, the customers of a dish leave and are seated again one after
another, given all else, for all restaurants in parallel; tables opened are
customers of the parent, which is then seated in turn. From the second doubling on
(more than EXACT customers of a dish) customers are seated in groups that
grow by a tenth. After BURN sweeps, the tables of KEPT sweeps are averaged;
the predictive probability is linear in them.

Word counts are exact and grow with the corpus: they are a table in the shared
folder. The counts of frequent words are broadcast (HEAD_WORDS, HEAD_BYTES);
the others meet their occurrences in a join whose keys are all rare.

Defined results: null text counts as empty (one end token); rows with equal id
and text are kept, each; a null id is scored and never learned from; without
training texts every score is 0.0. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (
    byte_batches, frequent_from, lower_words, mix, saved, prepare, string_hashes,
    text_buffers,
)

CLASSES = 1000
HEAD_WORDS = 500_000
HEAD_BYTES = 16 << 20
SLICE_BYTES = 3 << 20
BURN, KEPT = 2, 4
EXACT = 64
STRENGTH = 1.0  # concentration of every restaurant
END_WORD = ""  # key of the end token; no word is empty

PART_TOKENS = 4_000_000  # training tokens a part, whose rows a task holds packed in 32 bytes
GROUP_TOKENS = 500_000  # training tokens of a part's group: what a task seats at once
WIDE = 100_000  # words of this count or more have restaurants over many tasks
WIDE_BLOB = 200_000  # their rows a blob
HOT = 32  # a pair of this count in a slice is looked up, not shuffled

# codes of words: the start or end of a text, head words from FIRST by their
# place, other words by their hash with the top bit set
EDGE, FIRST, TOP = np.uint64(1), np.uint64(2), np.uint64(1 << 63)
NO_TEXT = np.uint32(0xFFFFFFFF)  # of rows that add customers only

RARE, END = 0, 1  # class numbers; words follow from 2


# --- seating ---


def seat(
    customers: np.ndarray, base: np.ndarray, tables: np.ndarray, discount: float,
    rng: np.random.Generator,
) -> np.ndarray:
    """Tables of each dish after its customers are seated anew. ``base``: the
    parent's probability of the dish; ``tables``: tables of its restaurant."""
    t = np.minimum(customers, 1).astype(float)
    pull = (STRENGTH + discount * tables) * base
    n = 1
    active = np.flatnonzero(customers > n)
    c, own, pull = customers[active], t[active], pull[active]
    while len(active):
        if n < EXACT:
            p = pull / (pull + np.maximum(n - discount * own, 1e-9))
            x = rng.random(len(p))  # as rng.binomial(1, p) draws
            own += np.where(p <= 0.5, x > 1 - p, x <= p)
            n += 1
        else:
            step = n // 10
            some = np.minimum(step, c - n).astype(np.int64)
            old = np.maximum(n + (some - 1) / 2 - discount * own, 1e-9)
            own += rng.binomial(some, pull / (pull + old))
            n += step
        more = c > n
        if not more.all():
            t[active] = own
            active, c, own, pull = active[more], c[more], own[more], pull[more]
    return t


def discount_of(once: float, twice: float) -> float:
    """Estimate from the numbers of dishes with one and two customers."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once and twice else 0.5


def parent_probability(
    customers: np.ndarray, tables: np.ndarray, discount: float
) -> np.ndarray:
    total = customers.sum()
    fresh = (STRENGTH + discount * tables.sum()) / len(customers)
    return (np.maximum(customers - discount * tables, 0) + fresh) / (STRENGTH + total)


class RareWords:
    """P(word | RARE) as a function of the word's training count. Dishes of
    equal count are exchangeable, so tables are averaged over GROUP dishes of
    every count on a grid, and between grid points in proportion."""

    GROUP = 64

    def __init__(self, counts: np.ndarray, dishes: np.ndarray):
        """``dishes``: number of rare words with each count."""
        self.grid, self.tables = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        self.customers, self.all_tables = 0.0, 0.0
        self.dishes = float(dishes.sum()) + 1  # and the unknown word
        self.discount = 0.5
        if not len(counts):
            return
        by = dict(zip(counts.tolist(), dishes.tolist()))
        self.discount = discount_of(by.get(1, 0), by.get(2, 0))
        self.customers = float((counts * dishes).sum())
        top = int(counts.max())
        grid = list(range(1, min(top, EXACT) + 1))
        while grid[-1] < top:
            grid.append(min(top, grid[-1] + max(1, grid[-1] // 4)))
        self.grid = np.array([0, *grid], float)
        each = np.repeat(np.array(grid), self.GROUP)
        mean, total = np.minimum(self.grid, 1), float(dishes.sum())
        kept = []
        for sweep in range(BURN + KEPT):
            rng = np.random.default_rng([17, sweep])
            t = seat(each, np.full(len(each), 1 / self.dishes), np.full(len(each), total),
                     self.discount, rng)
            mean = np.concatenate([[0.0], t.reshape(-1, self.GROUP).mean(axis=1)])
            total = float((np.interp(counts, self.grid, mean) * dishes).sum())
            if sweep >= BURN:
                kept.append((mean, total))
        self.tables = np.mean([m for m, _ in kept], axis=0)
        self.all_tables = float(np.mean([x for _, x in kept]))

    def log10(self, counts: np.ndarray) -> np.ndarray:
        fresh = (STRENGTH + self.discount * self.all_tables) / self.dishes
        seen = np.maximum(counts - self.discount * np.interp(counts, self.grid, self.tables), 0)
        return np.log10((seen + fresh) / (STRENGTH + self.customers))


def class_model(pairs: DataFrame, n_classes: int) -> np.ndarray:
    """(context, class) natural probabilities; ``pairs``: u, w, c. Contexts
    are the classes and, last, the start of a text."""
    n_contexts = n_classes + 1
    # restaurants stay together; a few of them to a task
    pairs = saved(pairs.repartition(max(1, n_contexts // 64), "u"), "pairs")
    per = pairs.groupBy("u").agg(
        F.sum("c").alias("c"), F.count("*").alias("dishes"),
        F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("once"),
        F.sum(F.when(F.col("c") == 2, 1).otherwise(0)).alias("twice"),
    ).toPandas()  # one row a context
    customers = np.zeros(n_contexts)
    customers[per.u] = per.c
    tables = np.zeros(n_contexts)
    tables[per.u] = per.dishes
    discount = discount_of(float(per.once.sum()), float(per.twice.sum()))
    parent_discount = 0.5
    dishes = pairs.groupBy("w").agg(F.count("*").alias("m")).toPandas()  # one row a class
    m = np.zeros(n_classes)
    m[dishes.w] = dishes.m
    own = np.minimum(m, 1)
    below = np.zeros((n_contexts, n_classes))
    kept: list[DataFrame] = []
    for sweep in range(BURN + KEPT):
        base = parent_probability(m, own, parent_discount)
        seated = saved(_seated(pairs, base, tables, discount, sweep), f"seating-{sweep}")
        by_u = seated.groupBy("u").agg(F.sum("t").alias("t")).toPandas()
        by_w = seated.groupBy("w").agg(F.sum("t").alias("t")).toPandas()
        tables, m = np.zeros(n_contexts), np.zeros(n_classes)
        tables[by_u.u], m[by_w.w] = by_u.t, by_w.t
        own = seat(m, np.full(n_classes, 1 / n_classes), np.full(n_classes, own.sum()),
                   parent_discount, np.random.default_rng([19, sweep]))
        if sweep >= BURN:
            kept.append(seated)
            base = parent_probability(m, own, parent_discount)
            back = (STRENGTH + discount * tables) / (STRENGTH + customers)
            below += back[:, None] * base[None, :] / KEPT
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    mean = every.groupBy("u", "w").agg(F.first("c").alias("c"), F.avg("t").alias("t"))
    seen = mean.toArrow()  # at most contexts x classes rows
    u, w, c, t = (seen.column(k).to_numpy() for k in ("u", "w", "c", "t"))
    below[u, w] += np.maximum(c - discount * t, 0) / (STRENGTH + customers[u])
    return below


def _seated(
    pairs: DataFrame, base: np.ndarray, tables: np.ndarray, discount: float, sweep: int
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, w, c = (batch.column(i).to_numpy() for i in range(3))
            rng = np.random.default_rng([sweep, len(u), *(int(x[0]) for x in (u, w) if len(x))])
            t = seat(c, base[w], tables[u], discount, rng)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t)], names=["u", "w", "c", "t"])

    return pairs.mapInArrow(run, "u int, w int, c bigint, t double")


# --- the corpus ---


class _Places:
    """Finds numbers in a sorted array of hashes: their top bits tell nearly
    where."""

    def __init__(self, hashes: np.ndarray):
        bits = len(hashes).bit_length() + 1
        self.n, self.shift = len(hashes), np.uint64(64 - bits)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        tops = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.searchsorted(hashes, tops).astype(np.int32)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The first place of each, -1 for those that are not there."""
        at = self.first[wanted >> self.shift]
        less = np.flatnonzero(self.hashes[at] < wanted)
        while len(less):
            at[less] += 1
            less = less[self.hashes[at[less]] < wanted[less]]
        return np.where((self.hashes[at] == wanted) & (at < self.n), at, -1)


@dataclass
class Model:
    total: int  # N, training tokens
    types: int  # V, distinct training tokens
    ends: int  # training texts
    least: int  # words of this count or more are in the head
    key: np.ndarray  # of head words, sorted
    check: np.ndarray
    count: np.ndarray
    klass: np.ndarray  # class of each head word
    log_class: np.ndarray  # (context, class) log10
    rare: RareWords | None
    slot: np.ndarray | None = None  # wide contexts by head word, -1: not wide
    slots: int = 1  # the first is the start of a text
    hot_u: np.ndarray | None = None  # codes of the hot pairs, by their hash
    hot_w: np.ndarray | None = None
    hot_value: np.ndarray | None = None
    texts: DataFrame | None = None  # training texts, on the driver only

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("places", "hot_places")} | {
            "texts": None}

    @cached_property
    def places(self) -> _Places:
        return _Places(self.key)

    @cached_property
    def hot_places(self) -> _Places:
        return _Places(pair_hash(self.hot_u, self.hot_w))

    def look_up(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code, in the head, count, class) of the distinct words of a batch."""
        n = len(words.key)
        if not len(self.key) or not n:
            return words.key | TOP, np.zeros(n, bool), np.zeros(n, np.int64), np.full(n, RARE)
        at = self.places(words.key)
        known = (at >= 0) & (self.check[at] == words.check)
        return (np.where(known, at.astype(np.uint64) + FIRST, words.key | TOP), known,
                np.where(known, self.count[at], 0), np.where(known, self.klass[at], RARE))

    def _of(self, code, values, other):
        if not len(self.key):
            return np.full(len(code), other)
        at = code - FIRST  # the start wraps around
        last = np.uint64(len(self.key) - 1)
        return np.where(at <= last, values[np.minimum(at, last).astype(np.int64)], other)

    def contexts(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, whether it is a rare word) of contexts."""
        return (np.where(u == EDGE, 0, self._of(u, self.slot, -1)),
                (u != EDGE) & (self._of(u, self.klass, RARE) == RARE))

    def dishes(self, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, count) of words; ``n``: the counts of those not in the head."""
        return (np.where(w == EDGE, END, self._of(w, self.klass, RARE)),
                np.where(w >= TOP, n, self._of(w, self.count, 0)))

    def dish_base(self, rare: np.ndarray, klass: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The parents' probability of dishes; ``rare``: after a rare word."""
        return 10.0 ** (np.where(klass == RARE, self.rare_log10(n), 0.0)
                        + np.where(rare, self.log_class[RARE, klass], 0.0))

    def hot(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The numbers of the hot pairs, -1 for others."""
        if self.hot_u is None or not len(self.hot_u):
            return np.full(len(u), -1)
        at = self.hot_places(pair_hash(u, w))
        found = np.flatnonzero(at >= 0)
        other = (self.hot_u[at[found]] != u[found]) | (self.hot_w[at[found]] != w[found])
        at[found[other]] = -1
        return at

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.types + 1)))

    def rare_log10(self, counts: np.ndarray) -> np.ndarray:
        return self.rare.log10(counts) if self.rare else np.zeros(len(counts))


def _sequences(words, klass: np.ndarray, n_classes: int):
    """(class of every token of a batch, ends included, class before each,
    text of each)."""
    n_docs = len(words.offsets) - 1
    n = np.diff(words.offsets)
    ends = np.cumsum(n + 1) - 1
    flat = np.full(int(n.sum()) + n_docs, END, np.int64)
    is_word = np.ones(len(flat), bool)
    is_word[ends] = False
    flat[is_word] = klass[words.which] if len(words.which) else 0
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[ends - n] = n_classes  # the start of a text
    return flat, before, np.repeat(np.arange(n_docs), n + 1)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Even slices of about ``most`` text bytes at most."""
    _, off = text_buffers(batch.column(batch.schema.get_field_index("text")))
    n = max(1, -(-int(off[-1]) // most))
    cuts = np.searchsorted(off[:-1], np.arange(1, n) * (off[-1] / n))
    cuts = np.unique([0, *cuts, batch.num_rows]).tolist()
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(lo, hi - lo)


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(u) + w)


def _order(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The rows in order of (u, w); equal pairs come in any order."""
    upper, lower = (np.where(x < TOP, x, x >> np.uint64(32)) for x in (u, w))
    order = np.argsort(upper << np.uint64(32) | lower)
    a, b = u[order], w[order]
    wrong = (a[1:] < a[:-1]) | ((a[1:] == a[:-1]) & (b[1:] < b[:-1]))
    if wrong.any():  # hashes with the same upper half
        run = upper[order]
        run = np.cumsum(np.concatenate([[0], run[1:] != run[:-1]]))
        bad = np.zeros(int(run[-1]) + 1, bool)
        bad[run[1:][wrong]] = True
        some = np.flatnonzero(bad[run])
        order[some] = order[some][np.lexsort((b[some], a[some], run[some]))]
    return order


def _order_by_place(place: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    order = _order(u, w)
    place = place[order]
    if len(place) and int(place.max()) < 1 << 16:
        place = place.astype(np.uint16)  # sorted by its digits
    return order[np.argsort(place, kind="stable")]


def _bigrams(words, flat: np.ndarray, before: np.ndarray, row: np.ndarray):
    """(text, distinct word before, distinct word) of the tokens of a batch
    that touch a rare word with the one before; -1: the start or the end."""
    which = np.full(len(flat), -1)
    is_word = np.ones(len(flat), bool)
    is_word[np.cumsum(np.diff(words.offsets) + 1) - 1] = False
    which[is_word] = words.which
    last = np.full(len(flat), -1)
    last[1:] = which[:-1]  # an end has -1, so the start of a text has
    use = np.flatnonzero((flat == RARE) | (before == RARE))
    return row[use], last[use], which[use]


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables cut only between values of the first column, which comes sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first = batch.column(0).to_numpy()
        if held and held[-1].column(0)[-1].as_py() != first[0]:
            yield pa.Table.from_batches(held)
            held = []
        lo = 0
        for cut in (np.flatnonzero(first[1:] != first[:-1]) + 1).tolist():
            yield pa.Table.from_batches([*held, batch.slice(lo, cut - lo)])
            held, lo = [], cut
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


# --- pairs of words, packed ---

_PAIRS = (np.uint64, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32)
_KEYS = (np.int64, np.int64, np.int32, np.uint8)
_BLOB = "part int, rows array<int>, payload binary, texts int, keys binary"


def _packed(columns) -> bytes:
    """Columns byte plane by byte plane, compressed, without the upper planes
    that are all zero; first the number of planes of each."""
    planes, used = [], []
    for x in columns:
        x = np.ascontiguousarray(x).view(f"<u{x.itemsize}")
        used.append((int(x.max()).bit_length() + 7) // 8 if len(x) else 0)
        planes.append(x.view(np.uint8).reshape(len(x), x.itemsize)[:, :used[-1]].T.tobytes())
    return bytes(used) + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(blob: pa.Buffer, rows: int, kinds) -> list[np.ndarray]:
    if not rows:
        return [np.empty(0, k) for k in kinds]
    used = list(blob[:len(kinds)].to_pybytes())
    ends = np.cumsum([0, *used]) * rows
    raw = np.empty(0, np.uint8)
    if ends[-1]:
        raw = np.frombuffer(
            pa.decompress(blob.slice(len(kinds)), int(ends[-1]), codec="zstd"), np.uint8)
    out = []
    for a, b, n, kind in zip(ends[:-1], ends[1:], used, kinds):
        bytes_of = np.zeros((rows, np.dtype(kind).itemsize), np.uint8)
        bytes_of[:, :n] = raw[a:b].reshape(n, rows).T
        out.append(bytes_of.view(kind).ravel())
    return out


def _blob(columns, keys) -> tuple[bytes, int, bytes]:
    """Rows (u, w, n, times, c, text), as a rule in order of u, and the keys of
    texts."""
    u, w, n, times, c, text = columns
    known = len(keys[0])
    if known <= 4 * len(text):  # few enough to number them by a table
        seen = np.zeros(known + 1, bool)
        seen[np.minimum(text, np.uint32(known))] = True
        own = np.flatnonzero(seen[:known])
        number = np.append((np.cumsum(seen[:known]) - 1).astype(np.uint32), NO_TEXT)
        text = number[np.minimum(text, np.uint32(known))]
    else:
        own = np.unique(text)
        own = own[own != NO_TEXT]
        text = np.where(text == NO_TEXT, NO_TEXT, np.searchsorted(own, text).astype(np.uint32))
    step = np.diff(u, prepend=np.uint64(0))
    kinds = zip(_PAIRS, (step, w, n, times, c, text))
    return (_packed([x.astype(k, copy=False) for k, x in kinds]), len(own),
            _packed([x[own] for x in keys]))


def _blobs(place: np.ndarray, groups: int, columns, keys) -> Iterator[pa.RecordBatch]:
    """One row for each part, of ``groups`` places; ``columns`` in order of
    place and u. ``rows``: of each group."""
    if not len(place):
        return
    part = place // groups
    ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
    out, lo = [], 0
    for hi in ends.tolist():
        rows = np.bincount(place[lo:hi] - part[lo] * groups, minlength=groups)
        out.append((int(part[lo]), rows.tolist(), *_blob([x[lo:hi] for x in columns], keys)))
        lo = hi
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*out), (
            pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary()))],
        names=["part", "rows", "payload", "texts", "keys"])


def _gathered(rows: pa.Table):
    """The pair rows of blobs, by group, and the text keys. A group is a list
    of columns for each blob."""
    groups: list[list] = []
    keys, texts = [], 0
    for i in range(rows.num_rows):
        sizes, payload, n_texts, own = (
            rows.column(x)[i] for x in ("rows", "payload", "texts", "keys"))
        sizes, n_texts = sizes.as_py(), n_texts.as_py()
        columns = _unpacked(payload.as_buffer(), sum(sizes), _PAIRS)
        np.cumsum(columns[0], out=columns[0])
        text = columns[5]
        text[text != NO_TEXT] += np.uint32(texts)
        groups = groups or [[] for _ in sizes]
        lo = 0
        for group, n in zip(groups, sizes):
            if n:
                group.append([x[lo:lo + n] for x in columns])
            lo += n
        keys.append(_unpacked(own.as_buffer(), n_texts, _KEYS))
        texts += n_texts
    return groups, [np.concatenate(x) for x in zip(*keys)]


def _text_keys(batch: pa.RecordBatch) -> list[np.ndarray]:
    doc, h, g = (batch.column(batch.schema.get_field_index(x)) for x in ("doc_id", "h", "g"))
    null = np.asarray(doc.is_null()).astype(np.uint8)
    return [doc.fill_null(0).to_numpy(zero_copy_only=False), h.to_numpy(), g.to_numpy(), null]


_OUT = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int64()), ("g", pa.int32()),
    ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
    ("u", pa.int64()), ("w", pa.int64()), ("c", pa.int64()), ("n", pa.int64()),
    ("m", pa.int64()), ("rows", pa.list_(pa.int32())), ("payload", pa.binary()), ("texts", pa.int32()),
    ("keys", pa.binary())])
_OUT_FIELDS = ("kind int, doc_id bigint, h bigint, g int, known bigint, base double, score double, "
               "u bigint, w bigint, c bigint, n bigint, m bigint, rows array<int>, payload binary, "
               "texts int, keys binary")
SUMS, HOT_PAIR, CELL, WIDE_ROWS = range(4)


def _out(kind: int, size: int, /, **columns) -> pa.RecordBatch:
    columns["kind"] = np.full(size, kind, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
         for f in _OUT], schema=_OUT)


class _Sums:
    """What pairs add to the texts of a part."""

    def __init__(self, keys):
        self.keys, self.sums = keys, np.zeros((3, len(keys[0])))

    def add(self, text, *values) -> None:
        """``values``: known, base and score; ``text``: of each, or NO_TEXT."""
        on = text != NO_TEXT
        for total, x in zip(self.sums, values):
            total += np.bincount(text[on], x[on], len(total))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row a text."""
        doc_id, h, g, null = self.keys
        if not len(h):
            return
        frame = pd.DataFrame({"doc_id": doc_id, "h": h, "g": g, "null": null} | dict(
            zip(("known", "base", "score"), self.sums)))
        frame = frame.groupby(["doc_id", "h", "g", "null"], sort=False).sum().reset_index()
        yield _out(SUMS, len(frame), doc_id=pa.array(
            frame.doc_id.to_numpy(), pa.int64(), mask=frame.null.to_numpy() == 1),
            h=frame.h.to_numpy(), g=frame.g.to_numpy(),
            known=frame.known.to_numpy().astype(np.int64),
            base=frame.base.to_numpy(), score=frame.score.to_numpy())


class _Pairs:
    """The distinct pairs of rows in order of (u, w), and what the model says
    of them."""

    def __init__(self, m: Model, u, w, n, c):
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
        starts = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1  # each row's pair
        self.u, self.w = u[starts], w[starts]
        self.c = np.add.reduceat(c.astype(np.int64), starts)
        self.context = np.cumsum(np.concatenate([[True], self.u[1:] != self.u[:-1]])) - 1
        self.slot, self.rare = m.contexts(self.u)
        self.klass, self.n = m.dishes(self.w, np.maximum.reduceat(n, starts).astype(np.int64))
        self.base = m.dish_base(self.rare, self.klass, self.n)
        self.starts = starts


def _batch_seats(c, base, tables, discount, sweep, w) -> np.ndarray:
    seed = [23, sweep, len(w), *(abs(int(x)) for x in w[:1])]
    return seat(c, base, tables, discount, np.random.default_rng(seed))


def _values(c, t, base, tables, customers, discount) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of P / back-off, log10 of the back-off weight) of pairs."""
    back = (STRENGTH + discount * tables) / (STRENGTH + customers)
    own = np.maximum(c - discount * t, 0) / (STRENGTH + customers)
    return np.log10(own / (base * back) + 1), np.log10(back)


def _seated_whole(p: _Pairs) -> np.ndarray:
    """log10 of P / parent of pairs whose contexts are all here."""
    one, more = np.flatnonzero(p.c == 1), np.flatnonzero(p.c > 1)
    n = int(p.context[-1]) + 1
    discount = discount_of(float(len(one)), float((p.c == 2).sum()))
    single = np.bincount(p.context[one], minlength=n).astype(float)
    tables = np.bincount(p.context[p.c > 0], minlength=n).astype(float)
    mean, mean_tables = np.minimum(p.c, 1).astype(float), np.zeros(n)
    mean[more] = 0
    for sweep in range(BURN + KEPT):
        t = _batch_seats(p.c[more], p.base[more], tables[p.context[more]], discount, sweep,
                         p.w[more])
        tables = single + np.bincount(p.context[more], t, n)
        if sweep >= BURN:
            mean[more] += t / KEPT
            mean_tables += tables / KEPT
    customers = np.bincount(p.context, p.c, n)
    value, back = _values(p.c, mean, p.base, mean_tables[p.context], customers[p.context], discount)
    return value + back


def _hot_values(m: Model, p: _Pairs, value: np.ndarray, chosen: np.ndarray):
    at = m.hot(p.u, p.w)
    found = np.flatnonzero((at >= 0) & chosen)
    if len(found):
        yield _out(HOT_PAIR, len(found), m=at[found], score=value[found])


def _settled(m: Model, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """All rows of a part, group by group."""
    groups, keys = _gathered(rows)
    sums = _Sums(keys)
    cells: list[pd.DataFrame] = []
    for group in groups:
        if group:
            yield from _settled_group(m, group, sums, cells)
    if cells:
        same = ["u", "known", "w", "c", "n"]
        frame = pd.concat(cells).groupby(same, sort=False, as_index=False).sum()
        yield _out(CELL, len(frame), **{k: frame[k].to_numpy().astype(np.int64) for k in frame})
    yield from sums.rows()


def _settled_group(
    m: Model, group, sums: _Sums, cells: list[pd.DataFrame]
) -> Iterator[pa.RecordBatch]:
    """Seats the contexts that are whole here, adds up their texts, and lays
    wide contexts aside; ``cells`` gets what their seating needs."""
    columns = [np.concatenate(x) for x in zip(*group)]
    order = _order(columns[0], columns[1])
    u, w, n, times, c, text = (x[order] for x in columns)
    del columns, order
    p = _Pairs(m, u, w, n, c)
    wide = p.slot >= 0
    value = np.where(wide, 0.0, _seated_whole(p))
    yield from _hot_values(m, p, value, ~wide)
    tail = p.w >= TOP  # words outside the head have not been counted yet
    score = value + np.where(tail, m.rare_log10(p.n), 0.0)
    sums.add(text, *(times * x[p.of] for x in (
        tail & (p.n > 0), np.where(tail, m.base(p.n), 0.0), score)))
    if not wide.any():
        return
    seen = np.flatnonzero(wide & (p.c > 0))
    more = p.c[seen] > 1  # one customer has one table
    own = pd.DataFrame({
        "u": p.slot[seen], "known": p.rare[seen] * more, "w": p.klass[seen] * more, "c": p.c[seen],
        "n": p.n[seen] * more})
    cells.append(own.groupby(list(own), sort=False).size().rename("m").reset_index())
    aside = np.flatnonzero(wide[p.of])
    pair = p.of[aside]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    lo = 0
    while lo < len(aside):  # cut between pairs
        end = np.searchsorted(first, lo + WIDE_BLOB)
        hi = int(first[end]) if end < len(first) else len(aside)
        some = aside[lo:hi]
        blob = _blob(
            [u[some], w[some], p.n[p.of[some]], times[some], c[some], text[some]], sums.keys)
        yield _out(WIDE_ROWS, 1, rows=[[len(some)]], **{
            k: [x] for k, x in zip(("payload", "texts", "keys"), blob)})
        lo = hi


def _wide_sums(shared, laid: DataFrame) -> tuple[DataFrame, int]:
    """Seats wide contexts, whose tables are summed over the tasks sweep by
    sweep, and adds up their texts."""
    m = shared.value
    cells = saved(laid.where(F.col("kind") == CELL).select("u", "w", "known", "c", "n", "m"), "cells")
    amount = F.when(F.col("c") == 1, F.col("m")), F.when(F.col("c") == 2, F.col("m"))
    per = cells.groupBy("u").agg(
        F.sum(F.col("c") * F.col("m")).alias("c"), F.sum("m").alias("t"),
        F.sum(amount[0]).alias("once"), F.sum(amount[1]).alias("twice"),
    ).toPandas()  # one row a slot
    customers, first = np.zeros(m.slots), np.zeros(m.slots)
    customers[per.u], first[per.u] = per.c, per.t
    discount = discount_of(float(per.once.sum()), float(per.twice.sum()))
    single = np.zeros(m.slots)
    single[per.u] = per.once.fillna(0)
    states = [first]

    for sweep in range(BURN + KEPT):
        now = states[-1]

        def sums(batches, now=now, sweep=sweep):
            m = shared.value
            total = np.zeros(m.slots)
            for batch in batches:
                u, w, rare, c, n, times = (x.to_numpy() for x in batch.columns)
                base = m.dish_base(rare > 0, w, n)
                group = (np.cumsum(times) - 1) >> 20  # about 2**20 dishes at once
                cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1)).tolist()
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    each = np.repeat(np.arange(lo, hi), times[lo:hi])
                    total += np.bincount(u[each], _batch_seats(
                        c[each], base[each], now[u[each]], discount, sweep, n[lo:hi]), m.slots)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["u", "t"])

        got = cells.where("c > 1").mapInArrow(sums, "u bigint, t double").groupBy("u").agg(
            F.sum("t").alias("t")).toPandas()
        state = single.copy()
        state[got.u] += got.t
        states.append(state)
    tables = np.mean(states[-KEPT:], axis=0)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                [[(u, w, n, times, c, text)]], keys = _gathered(
                    pa.Table.from_batches([batch.slice(i, 1)]))
                p, sums = _Pairs(m, u, w, n, c), _Sums(keys)
                mean = np.minimum(p.c, 1).astype(float)
                more = np.flatnonzero(p.c > 1)
                mean[more] = np.mean([
                    _batch_seats(p.c[more], p.base[more], states[s][p.slot[more]], discount, s,
                                 p.w[more]) for s in range(BURN, BURN + KEPT)], axis=0)
                value, back = _values(
                    p.c, mean, p.base, tables[p.slot], customers[p.slot], discount)
                value += back
                yield from _hot_values(m, p, value, np.ones(len(value), bool))
                none = np.zeros(len(u))
                sums.add(text, none, none, times * value[p.of])
                yield from sums.rows()

    blobs = laid.where(F.col("kind") == WIDE_ROWS).select("rows", "payload", "texts", "keys")
    return blobs.mapInArrow(valued, _OUT_FIELDS)


# --- fitting ---


def _head_arrays(rows: pa.Table, n_classes_words: int):
    data, off = text_buffers(rows.column("word"))
    key, check = string_hashes(data, off[:-1], np.diff(off))
    count = rows.column("n").to_numpy()
    klass = np.full(len(count), RARE)
    klass[:n_classes_words] = 2 + np.arange(min(n_classes_words, len(count)))
    order = np.argsort(key)
    return key[order], check[order], count[order], klass[order]


def _codes(words: pa.Array) -> np.ndarray:
    """Codes of words outside the head."""
    data, off = text_buffers(words)
    if not len(words):
        return np.empty(0, np.uint64)
    return string_hashes(data, off[:-1], np.diff(off))[0] | TOP


def fit(docs: DataFrame, learn: Column) -> tuple[Model, DataFrame]:
    """(model, table of word counts) from the rows where ``learn`` holds. The
    restaurants of words are seated by :func:`score`, whose one shuffle of
    pairs serves both."""
    prepare(docs.sparkSession)
    texts = docs.where(F.coalesce(learn, F.lit(False))).select(
        F.coalesce(F.col("text"), F.lit("")).alias("text")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                w = lower_words(*text_buffers(part.column(0)))
                k = len(w.key)
                strings = pa.concat_arrays([w.strings(np.arange(k)), pa.array([END_WORD])])
                n = np.append(np.bincount(w.which, minlength=k), part.num_rows)
                yield pa.RecordBatch.from_arrays([strings, pa.array(n)], names=["word", "n"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_codes(batch.column(0)).view(np.int64))], names=["key"])

    table = saved(
        texts.mapInArrow(counted, "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")), "word-counts",
    )
    whole = table.agg(
        F.sum("n").alias("total"), F.count("*").alias("types"),
        F.sum(F.when(F.col("word") == END_WORD, F.col("n"))).alias("ends"),
    ).first()
    empty = np.empty(0, np.uint64)
    if not whole["types"]:
        return Model(0, 0, 0, 1 << 62, empty, empty, empty, empty, np.zeros((3, 2)), None), table
    words = table.where(F.col("word") != END_WORD)
    keyed = words.select("word").mapInArrow(keys, "key bigint")
    if keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError("two words share a hash")
    least = frequent_from(words, F.octet_length("word"), HEAD_WORDS, HEAD_BYTES)
    if least is None:
        key, check, count, klass = (empty,) * 4
        least = 1 << 62
    else:
        rows = words.where(F.col("n") >= least).toArrow().combine_chunks()
        rows = rows.sort_by([("n", "descending"), ("word", "ascending")])
        key, check, count, klass = _head_arrays(rows, min(CLASSES, len(rows)))
    n_words = int((klass != RARE).sum()) if len(klass) else 0
    n_classes = n_words + 2
    model = Model(whole["total"], whole["types"], whole["ends"] or 0, least, key, check, count,
                  klass, np.zeros((n_classes + 1, n_classes)), None, texts=texts)
    wide = (klass != RARE) | (count >= WIDE)
    model.slot = np.where(wide, np.cumsum(wide), -1)
    model.slots = int(wide.sum()) + 1
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total = np.zeros((n_classes + 1) * n_classes, np.int64)
        names = ["u", "w", "c", "hot"]
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                w = lower_words(*text_buffers(part.column(0)))
                code, _, _, klass = m.look_up(w)
                flat, before, row = _sequences(w, klass, n_classes)
                total += np.bincount(before * n_classes + flat, minlength=len(total))
                _, last, which = _bigrams(w, flat, before, row)
                code = np.append(code, EDGE)
                a, b = code[last], code[which]
                h = pair_hash(a, b)
                bucket = (h >> np.uint64(44)).astype(np.int64)  # few are counted one by one
                some = (np.bincount(bucket, minlength=1 << 20)[bucket] >= HOT) & (a < TOP) & (b < TOP)
                _, one, c = np.unique(h[some], return_index=True, return_counts=True)
                a, b, hot = a[some][one], b[some][one], c >= HOT
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[hot].view(np.int64)), pa.array(b[hot].view(np.int64)),
                     pa.array(c[hot]), pa.array(np.ones(int(hot.sum()), bool))], names=names)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // n_classes), pa.array(at % n_classes), pa.array(total[at]),
             pa.array(np.zeros(len(at), bool))], names=names)

    counts = saved(texts.mapInArrow(paired, "u bigint, w bigint, c bigint, hot boolean").groupBy(
        "u", "w", "hot").agg(F.sum("c").alias("c")), "pair-counts")
    model.log_class = np.log10(class_model(
        counts.where("NOT hot").select(F.col("u").cast("int"), F.col("w").cast("int"), "c"),
        n_classes)).astype(np.float32)
    hot = counts.where("hot").select("u", "w", F.col("c").alias("n"))
    if (at_least := frequent_from(hot, F.lit(24), HEAD_WORDS, HEAD_BYTES)) is not None:
        rows = hot.where(F.col("n") >= at_least).toArrow()
        u, w = (rows.column(x).to_numpy().view(np.uint64) for x in "uw")
        order = np.argsort(pair_hash(u, w))
        model.hot_u, model.hot_w = u[order], w[order]
    # rare words by count: exact up to EXACT, then by the mean of small steps
    step = F.when(F.col("n") <= EXACT, F.col("n").cast("double")).otherwise(
        F.floor(F.log2("n") * 64) + (1 << 20)
    )
    chosen = (klass != RARE) if len(klass) else np.zeros(0, bool)
    hist = words.groupBy(step.alias("step")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words")
    ).toPandas()  # 64 rows a power of two
    taken = pd.DataFrame({"n": count[chosen].astype(float)})
    taken["step"] = np.where(taken.n <= EXACT, taken.n,
                             np.floor(np.log2(taken.n.clip(lower=1)) * 64) + (1 << 20))
    less = taken.groupby("step").agg(n=("n", "sum"), words=("n", "size"))
    hist = hist.set_index("step")[["n", "words"]].sub(less, fill_value=0)
    hist = hist[hist.words > 0]
    model.rare = RareWords((hist.n / hist.words).to_numpy(), hist.words.to_numpy())
    return model, table


# --- scoring ---


def _pair_sums(rows: DataFrame, model: Model, table: DataFrame) -> list[DataFrame]:
    """What pairs and words outside the head add to texts (kind SUMS), and the
    values of hot pairs. ``rows``: text, doc_id, h, g, train, scored."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    n_classes = model.log_class.shape[1]
    parts = max(1, -(-model.total // PART_TOKENS))
    groups = max(1, -(-model.total // (parts * GROUP_TOKENS)))

    def place_of(u, w):
        """The number of a group in all parts."""
        spread = shared.value.contexts(u)[0] >= 0  # a wide context is dealt by its words
        h = np.where(spread, pair_hash(u, w), mix(u))
        return (h % np.uint64(parts * groups)).astype(np.int64)

    def pairs_of(part):
        words = lower_words(*text_buffers(part.column(0)))
        code, known, _, klass = shared.value.look_up(words)
        row, last, which = _bigrams(words, *_sequences(words, klass, n_classes))
        return words, np.append(code, EDGE), np.append(known, True)[which], row, last, which

    def slices(batches):
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                yield part, *pairs_of(part)

    def flags(part):
        return (np.asarray(part.column(i).to_numpy(zero_copy_only=False)) for i in (4, 5))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, words, code, head, row, last, which in slices(batches):
            train, scored = flags(part)
            row, u, w = row[head], code[last[head]], code[which[head]]
            del words, code, head, last, which  # a task has little memory
            c = train[row].astype(np.uint32)
            text = np.where(scored[row], row, NO_TEXT).astype(np.uint32)
            del row
            at = m.hot(u, w)
            if (at >= 0).any():  # hot pairs send their customers only
                n = np.bincount(at[at >= 0], c[at >= 0])
                own = np.flatnonzero(n)
                rest = at < 0
                u, w = np.append(u[rest], m.hot_u[own]), np.append(w[rest], m.hot_w[own])
                c = np.append(c[rest], n[own].astype(np.uint32))
                text = np.append(text[rest], np.full(len(own), NO_TEXT, np.uint32))
            del at
            place = place_of(u, w)
            order = _order_by_place(place, u, w)
            none = np.zeros(len(u), np.uint32)
            u, w, c, text, place = (x[order] for x in (u, w, c, text, place))
            del order
            columns = [u, w, none, none + np.uint32(1), c, text]
            yield from _blobs(place, groups, columns, _text_keys(part))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, code, head, row, last, which in slices(batches):
            row, last, which = row[~head], last[~head], which[~head]
            train, scored = flags(part)
            k = np.int64(len(words.key) + 1)
            _, one, times = np.unique(  # a pair once a text
                (row * k + last + 1) * k + which, return_index=True, return_counts=True)
            row, last, which = row[one], last[one], which[one]
            to = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [words.strings(which), pa.array(code[last].view(np.int64)),
                 pa.array(times.astype(np.int32)),
                 part.column(1).take(to), part.column(2).take(to), part.column(3).take(to),
                 pa.array(train[row]), pa.array(scored[row])],
                names=["word", "u", "times", "doc_id", "h", "g", "train", "scored"])

    def tail_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in byte_batches(batches, lambda b: b.num_rows, 200_000):
            rows = pa.Table.from_batches(held).combine_chunks()
            if not rows.num_rows:
                continue
            batch = rows.to_batches()[0]
            u, n, times = (batch.column(i).to_numpy() for i in (1, 2, 3))
            u, w = u.view(np.uint64), _codes(batch.column(0))
            train, scored = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            times = times.astype(np.uint32)
            text = np.where(scored, np.arange(len(u)), NO_TEXT).astype(np.uint32)
            place = place_of(u, w)
            order = _order_by_place(place, u, w)
            columns = [x[order] for x in (u, w, n.astype(np.uint32), times, times * train, text)]
            yield from _blobs(place[order], groups, columns, _text_keys(batch))

    few = table.where((F.col("n") < model.least) & (F.col("word") != END_WORD)).select("word", "n")
    met = rows.mapInArrow(
        tails, "word string, u bigint, times int, doc_id bigint, h bigint, g int, "
        "train boolean, scored boolean").join(few, "word", "left").select(
        "word", "u", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "times", "train", "scored",
        "doc_id", "h", "g")
    blobs = rows.mapInArrow(dealt, _BLOB).unionByName(met.mapInArrow(tail_dealt, _BLOB))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_runs(batches):
            yield from _settled(shared.value, part)

    laid = saved(blobs.repartition("part").sortWithinPartitions("part").mapInArrow(
        settled, _OUT_FIELDS), "pairs")
    return [laid, saved(_wide_sums(shared, laid), "wide-pairs")]


def score(
    docs: DataFrame, model: Model, table: DataFrame, learn: Column | None = None
) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row: log10
    probabilities of the text, by add-0.1 unigrams and by the model.
    ``learn``: the condition of :func:`fit`, if ``docs`` are the rows that it
    was given; their texts are then read once for seating and scoring."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.lit(False) if learn is None else F.coalesce(learn, F.lit(False))
    keyed = docs.select(
        text.alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("h"), F.hash(text).alias("g"), own.alias("train"),
        F.lit(True).alias("scored"))
    found: list[DataFrame] = []
    if model.rare is not None:
        rows = keyed
        if learn is None:
            rows = rows.unionByName(model.texts.select(
                "text", F.lit(None).cast("bigint").alias("doc_id"),
                F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("g"), F.lit(True).alias("train"),
                F.lit(False).alias("scored")))
        found = _pair_sums(rows, model, table)
        if model.hot_u is not None:
            model.hot_value = np.zeros(len(model.hot_u))
            for each in found:
                hot = each.where(F.col("kind") == HOT_PAIR).select("m", "score").toArrow()
                model.hot_value[hot.column("m").to_numpy()] = hot.column("score").to_numpy()
    shared = spark.sparkContext.broadcast(model)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                w = lower_words(*text_buffers(part.column(0)))
                code, known, count, klass = m.look_up(w)
                flat, before, row = _sequences(w, klass, m.log_class.shape[1])
                n = part.num_rows
                total = np.bincount(row, m.log_class[before, flat].astype(float), n)
                of = np.repeat(np.arange(n), np.diff(w.offsets))
                head = known[w.which]
                base = np.bincount(of, np.where(known, m.base(count), 0.0)[w.which], n)
                rare = np.where(known & (klass == RARE), m.rare_log10(count), 0.0)
                total += np.bincount(of, rare[w.which], n)
                if m.hot_value is not None:
                    row, last, which = _bigrams(w, flat, before, row)
                    code = np.append(code, EDGE)
                    at = m.hot(code[last], code[which])
                    total += np.bincount(row[at >= 0], m.hot_value[at[at >= 0]], n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), part.column(3), pa.array(np.ones(n, np.int64)),
                     pa.array(np.diff(w.offsets) + 1),
                     pa.array(np.bincount(of, head, n).astype(np.int64) + (m.ends > 0)),
                     pa.array(base + m.base(np.array([m.ends]))[0]), pa.array(total)],
                    names=["doc_id", "h", "g", "rows", "n_tokens", "n_known", "base_score", "score"],
                )

    scores = keyed.mapInArrow(
        frequent, "doc_id bigint, h bigint, g int, rows bigint, n_tokens bigint, n_known bigint, "
        "base_score double, score double")
    zero = F.lit(0).cast("bigint")
    for each in found:
        scores = scores.unionByName(each.where(F.col("kind") == SUMS).select(
            "doc_id", "h", "g", zero.alias("rows"), zero.alias("n_tokens"),
            F.col("known").alias("n_known"), F.col("base").alias("base_score"), "score"))
    sums = scores.groupBy("doc_id", "h", "g").agg(*(F.sum(c).alias(c) for c in
                                   ("rows", "n_tokens", "n_known", "base_score", "score")))
    # equal rows were added up: share the sums and return each
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))
    return sums.select(
        "doc_id",
        *(F.expr(f"{c} div rows").alias(c) for c in ("n_tokens", "n_known")),
        *((F.col(c) / F.col("rows")).alias(c) for c in ("base_score", "score")),
        each.alias("copy"),
    ).drop("copy")
