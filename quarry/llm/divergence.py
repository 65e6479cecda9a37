"""Source divergence audit: how far the term frequencies of a language's
sources lie from each other, by a frequent-pattern tree of term rows.

Terms are runs of ASCII letters and of characters outside ASCII, only A-Z
lower-cased. A language keeps the V terms that occur in at least ``min_docs``
of its documents. A group, that is a language's source or the language itself,
gives a kept term of c occurrences p(c) = 1 + floor(SCALE * (c + PRIOR) / (N +
PRIOR * V)), N being the group's occurrences of kept terms.

The distance of sources a and b is the sum of |p_a - p_b| over all kept terms.
With z = p(0) it is taken apart into

* V |z_a - z_b|, as if no term occurred in either;
* for every term in a, whatever b is, |p_a - z_b| - |z_a - z_b|, and the same
  for b: from the number of terms of each (source, p);
* for every term in both, the pair correction
  |p_a - p_b| - |p_a - z_b| - |z_a - p_b| + |z_a - z_b|.

**Tree.** A term's row is its sources with nonzero counts, in the order of the
sources. Equal rows are counted, the rows dealt by ranges and sorted, so that
a task meets the tree of its rows in depth-first order and holds one path of
it. A node, with the number of terms below it, adds its pair corrections with
its ancestors once, when it is left. Sums of pairs leave a task summed up to
PAIRS of them at a time. Rows are as long as a language has sources; the
result is the square of that.

All arithmetic is on whole numbers. p is computed in decimals of 38 digits;
sums must fit 63 bits, else the job fails.

Defined results: null text, lang and source read as ''. Every occurring
(lang, source) is a group, also without terms; if V is 0 its distances are 0.
Rows of one id, and repeated rows, are separate documents. Part 'term' lists
the terms of a group that are more frequent than in the language, the first
``top`` by difference; equal values rank by item in UTF-8 order. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import LOWER, Words, prepare, saved, sliced, text_buffers

MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP = 50
SLICE = 4 << 20  # text bytes that are worked on at once
PAIRS = 200_000  # sums that a task holds before it passes them on

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.frombuffer(LOWER, np.uint8)

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
FOUND = "lang string, source string, other string, p bigint, z bigint, value bigint"


def _terms(data: np.ndarray, offsets: np.ndarray) -> Words:
    solid = _LETTER[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = solid[at]
    return Words(_LOWER[data], solid, first, offsets)


def _slice_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """(group, term, occurrences, documents) of the texts of a slice."""
    words = _terms(data, offsets)
    doc = np.repeat(np.arange(len(group)), np.diff(words.offsets))
    pair, n = np.unique(words.which * len(group) + doc, return_counts=True)
    of, which = np.unique(
        pair // len(group) * (group.max() + 1) + group[pair % len(group)], return_inverse=True)
    total = np.bincount(which, weights=n).astype(np.int64)  # exact below 2**53
    docs = np.bincount(which).astype(np.int64)
    return of % (group.max() + 1), words.strings(of // (group.max() + 1)), total, docs


def _long_counts(data: np.ndarray):
    """(terms, occurrences) of one long text, piece by piece."""
    n: Counter = Counter()
    lo = 0
    while lo < len(data):
        hi = lo + SLICE
        while hi < len(data) and _LETTER[data[hi]]:
            hi += 1
        words = _terms(data[lo:hi], np.array([0, min(hi, len(data)) - lo]))
        if len(words.key):
            each = np.bincount(words.which, minlength=len(words.key))
            n.update(dict(zip(words.strings(np.arange(len(each))).to_pylist(), each.tolist())))
        lo = hi
    return list(n), list(n.values())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for whole in batches:
        for batch in sliced(whole, "text", SLICE):
            data, offsets = text_buffers(batch.column("text"))
            keys = pd.MultiIndex.from_arrays([batch.column(c).to_pylist() for c in names[:2]])
            group, found = keys.factorize()
            langs, sources = (pa.array(found.get_level_values(i), pa.string()) for i in (0, 1))
            if len(data) > 2 * SLICE:  # a slice of one text
                terms, n = _long_counts(data)
                of, docs = np.zeros(len(terms), np.int64), np.ones(len(terms), np.int64)
                terms = pa.array(terms, pa.string())
            elif len(data):
                of, terms, n, docs = _slice_counts(data, offsets, group)
            else:
                continue
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(of)), sources.take(pa.array(of)), terms,
                 pa.array(n, pa.int64()), pa.array(docs)], names=names)


def _plain(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term in a group and
    the documents that have it."""
    prepare(docs.sparkSession)
    each = _plain(docs, "lang", "source", "text").mapInArrow(_counted, COUNTS)
    return each.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms: str) -> Column:
    """p of a term of ``n`` occurrences in a group of ``total``."""
    whole = "decimal(20, 0)"
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + {PRIOR} as {whole})) "
        f"div cast({total} + {PRIOR} * {terms} as {whole})")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the tree of sorted (lang, path, times) rows. Rows with
    ``other`` are sums of pair corrections, those without are numbers of terms
    of (source, p)."""
    names = ["lang", "source", "other", "p", "z", "value"]
    sums: dict[tuple, int] = {}
    single: dict[tuple, int] = {}
    lang: str | None = None
    path: list[tuple] = []  # (source, p, z) from the root, and
    times: list[int] = []  # the terms that end at or below each

    def leave(depth: int) -> None:
        while len(path) > depth:
            (b, p_b, z_b), m = path.pop(), times.pop()
            if times:
                times[-1] += m
            single[lang, b, p_b, z_b] = single.get((lang, b, p_b, z_b), 0) + m
            for a, p_a, z_a in path:
                extra = abs(p_a - p_b) - abs(p_a - z_b) - abs(z_a - p_b) + abs(z_a - z_b)
                if extra:
                    sums[lang, a, b] = sums.get((lang, a, b), 0) + m * extra

    def passed_on() -> pa.RecordBatch:
        rows = [(g, a, b, None, None, v) for (g, a, b), v in sums.items()]
        rows += [(g, a, None, p, z, v) for (g, a, p, z), v in single.items()]
        sums.clear()
        single.clear()
        kinds = [pa.string()] * 3 + [pa.int64()] * 3
        columns = zip(*rows) if rows else [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "path", "times")))
        for now, row, m in rows:
            row = [(x["source"], x["p"], x["z"]) for x in row]
            shared = 0
            if now == lang:
                while shared < min(len(row), len(path)) and row[shared] == path[shared]:
                    shared += 1
            leave(shared)
            lang = now
            path += row[shared:]
            times += [0] * (len(row) - shared)
            times[-1] += m
            if len(sums) + len(single) > PAIRS:
                yield passed_on()
    leave(0)
    yield passed_on()


def tree_corrections(rows: DataFrame) -> DataFrame:
    """FOUND rows of the tree of (lang, term, source, p, z) rows."""
    entry = F.struct("source", "p", "z")
    paths = rows.groupBy("lang", "term").agg(F.array_sort(F.collect_list(entry)).alias("path"))
    counted = paths.groupBy("lang", "path").agg(F.count("*").alias("times"))
    # ranges of short keys: the driver gets a sample of them. Rows of one hot
    # beginning are split by their hash.
    near = counted.repartitionByRange("lang", F.slice("path", 1, 2), F.xxhash64("path"))
    return near.sortWithinPartitions("lang", "path").mapInArrow(_walk, FOUND)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): the distances to the other
    sources of the language, and the terms above the language's share."""
    counts = saved(term_counts(docs), "divergence-counts")
    kept = saved(
        counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    nonzero = saved(counts.join(kept, ["lang", "term"]).drop("docs"), "divergence-nonzero")
    langs = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    totals = nonzero.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = saved(
        _plain(docs, "lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
        .withColumn("z", F.when(F.col("terms") > 0, share("0", "total", "terms"))
                    .otherwise(F.lit(0))), "divergence-groups")
    shares = saved(
        nonzero.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "z", share("n", "total", "terms").alias("p"),
            share("in_lang", "lang_total", "terms").alias("q")), "divergence-shares")

    found = saved(tree_corrections(shares), "divergence-tree")
    one = groups.select("lang", F.col("source").alias("one"), F.col("z").alias("z_one"), "terms")
    other = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("z_other"))
    first, second = F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other")
    apart = F.abs(F.col("z_one") - F.col("z_other"))
    absent = one.join(other, "lang").where("one < other").select(
        "lang", "one", "other", (F.col("terms") * apart).alias("value"))
    histogram = found.where("other IS NULL").groupBy("lang", "source", "p", "z").agg(
        F.sum("value").alias("times"))
    alone = histogram.select(
        "lang", F.col("source").alias("one"), F.col("z").alias("z_one"), "p", "times"
    ).join(other, "lang").where("one <> other").select(
        "lang", first, second,
        (F.col("times") * (F.abs(F.col("p") - F.col("z_other")) - apart)).alias("value"))
    both = found.where("other IS NOT NULL").select(
        "lang", F.col("source").alias("one"), "other", "value")
    pairs = absent.unionByName(alone).unionByName(both).groupBy("lang", "one", "other").agg(
        F.sum("value").alias("value"))
    sides = F.explode(F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    pair_rows = pairs.select("lang", sides.alias("s"), "value").select(
        "lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", rank)
    term_rows = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value")).withColumn("rank", rank).where(
        F.col("rank") <= top)
    return pair_rows.unionByName(term_rows)
