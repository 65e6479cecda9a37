"""Quality classifier: a sparse rule ensemble over document statistics.

1. Statistics of every whole text, from one pass over its bytes and word
   hashes (:func:`with_statistics`).
2. Small random-forest trees are grown on labelled rows; every path from a
   root to a node is a conjunctive rule ``stat <= a AND stat > b AND ...``.
3. A lasso logistic regression over rules and scaled statistics leaves few
   non-zero weights.
4. The weighted rules are compiled into one Spark column expression, which
   scores any number of rows inside the JVM (:meth:`RuleEnsemble.score`).

Trees and weights are fitted by Spark on about FIT_ROWS labelled rows, chosen
by a hash of the id; with fewer, on all. Scores cover every row.

Defined results: null text counts as empty and gets the score of the empty
text's statistics; rows with a null id are scored and never learned from;
repeated rows are scored each; labels for unknown ids, null labels and rows
without a label are not used; of several labels of an id the lowest counts;
without labels of both kinds every score is the share of label 1 (1.0 without
labels). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved, shingles, sliced, prepare, text_buffers, word_hashes

FIT_ROWS = 100_000  # labelled rows that trees and weights are fitted on, about
TREES = 24
DEPTH = 3
LASSO = 0.0005
KEEP = 0.7  # scores from here on predict label 1
SEED = 7

_SETS = {
    "upper": bytes(range(65, 91)), "digit": b"0123456789", "stop": b".", "comma": b",;:",
    "bang": b"!?", "pipe": b"|", "symbol": b"#$%&*~^=+@_", "bracket": b"<>[]{}()/\\",
    "quote": b"\"'`", "dash": b"-",
}
STATISTICS = [
    "log_chars", "log_words", "log_lines", "word_length", "short_words", "long_words",
    "line_words", *(f"{k}_share" for k in _SETS), "high_share", "space_share",
    "distinct_words", "top_word", "repeated_shingles", "repeated_lines", "odd_lines",
]


def _shares(part: np.ndarray) -> list[float]:
    """Shares of bytes of each set, beyond ASCII, and white space."""
    n = np.bincount(part, minlength=256)
    total = max(len(part), 1)
    sets = [float(n[list(s)].sum()) / total for s in _SETS.values()]
    return [*sets, float(n[128:].sum()) / total, float(n[9:14].sum() + n[32]) / total]


def _repeats(h: np.ndarray) -> tuple[float, float]:
    """(share of distinct values, share of the most frequent one)."""
    if not len(h):
        return 1.0, 0.0
    _, n = np.unique(h, return_counts=True)
    return len(n) / len(h), float(n.max()) / len(h)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, statistic) of a batch, in the order of STATISTICS."""
    words, woff = word_hashes(data, offsets)
    five, soff = shingles(words, woff, 5)
    out = np.zeros((len(offsets) - 1, len(STATISTICS)))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        part, w, s = data[a:b], words[woff[i]:woff[i + 1]], five[soff[i]:soff[i + 1]]
        white = np.isin(part, (9, 10, 11, 12, 13, 32))
        gaps = np.flatnonzero(np.concatenate([[True], white, [True]]))
        lens = np.diff(gaps) - 1
        lens = lens[lens > 0]
        breaks = np.flatnonzero(np.concatenate([[True], part == 10, [True]]))
        lines = [part[x:y - 1].tobytes() for x, y in zip(breaks[:-1], breaks[1:]) if y - x > 1]
        n_lines, n_words = max(len(lines), 1), max(len(w), 1)
        distinct, top = _repeats(w)
        marks = sum(not ln.rstrip().endswith((b".", b"!", b"?", b":", b'"')) for ln in lines)
        out[i] = [
            np.log1p(np.count_nonzero((part & 0xC0) != 0x80)), np.log1p(len(w)),
            np.log1p(len(lines)), lens.mean() if len(lens) else 0.0,
            float((lens <= 3).mean()) if len(lens) else 0.0,
            float((lens >= 14).mean()) if len(lens) else 0.0,
            min(n_words / n_lines, 1000.0), *_shares(part), distinct, top,
            1.0 - _repeats(s)[0], 1.0 - len(set(lines)) / n_lines if lines else 0.0,
            marks / n_lines,
        ]
    return out


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with an array column ``statistics`` (replacing any such)."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != "statistics"]
    source = docs.select(*kept, F.col(text_column).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "__text"):
                values = statistics(*text_buffers(part.column(len(kept))))
                flat = pa.array(values.ravel())
                column = pa.FixedSizeListArray.from_arrays(flat, len(STATISTICS)).cast(
                    pa.list_(pa.float64())
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], column], names=[*kept, "statistics"]
                )

    fields = [f"`{c}` {t}" for c, t in docs.select(*kept).dtypes]
    return source.mapInArrow(run, ", ".join([*fields, "statistics array<double>"]))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic number, is upper bound, threshold)."""

    bounds: tuple[tuple[int, bool, float], ...]

    def column(self, statistics_column: Column) -> Column:
        out = F.lit(True)
        for i, upper, at in self.bounds:
            x = statistics_column[i]
            out = out & (x <= F.lit(at) if upper else x > F.lit(at))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{STATISTICS[i]} {'<=' if u else '>'} {t:.4g}"
                            for i, u, t in self.bounds)


def _tree_rules(node, path: dict) -> Iterator[Rule]:
    """Rules of all nodes under a tree node; bounds of one statistic merge."""
    if path:
        yield Rule(tuple((i, u, t) for (i, u), t in sorted(path.items())))
    if node.numDescendants() == 0:
        return
    split = node.split()
    i, t = int(split.featureIndex()), float(split.threshold())
    up, down = path.get((i, True), np.inf), path.get((i, False), -np.inf)
    yield from _tree_rules(node.leftChild(), {**path, (i, True): min(up, t)})
    yield from _tree_rules(node.rightChild(), {**path, (i, False): max(down, t)})


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]  # with non-zero weights
    linear: tuple[tuple[int, float, float, float], ...]  # statistic, low, high, weight

    def score(self, statistics_column: Column) -> Column:
        """Probability of label 1, as one column expression."""
        z = F.lit(self.intercept)
        for rule, w in self.rules:
            z = z + F.when(rule.column(statistics_column), w).otherwise(0.0)
        for i, low, high, w in self.linear:
            z = z + _scaled(statistics_column[i], low, high) * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _scaled(x: Column, low: float, high: float) -> Column:
    """0 to 1 between the bounds, cut off outside."""
    return F.greatest(F.least((x - F.lit(low)) / F.lit(high - low), F.lit(1.0)), F.lit(0.0))


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """An ensemble from the columns doc_id, statistics and quality (0 or 1)."""
    known = rows.where(F.col("quality").isin(0, 1))
    n = {r["quality"]: r["n"] for r in
         known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    if len(n) < 2:
        share = n.get(1, 0) / total if total else 1.0
        p = min(max(share, 1e-6), 1 - 1e-6)
        return RuleEnsemble(float(np.log(p / (1 - p))), (), ())
    chosen = known.where(_chosen(fit_rows, total))
    data = saved(
        chosen.select("statistics", array_to_vector("statistics").alias("features"),
                      F.col("quality").cast("double").alias("label")), "quality-fit",
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="0.4", subsamplingRate=0.7,
        minInfoGain=1e-5, seed=SEED,
    ).fit(data)
    rules = list(dict.fromkeys(
        rule for tree in forest.trees for rule in _tree_rules(tree._call_java("rootNode"), {})
    ))
    ends = data.select(*(
        F.percentile_approx(F.col("statistics")[i], [0.025, 0.975], 1000).alias(str(i))
        for i in range(len(STATISTICS))
    )).first()
    linear = [(i, float(ends[i][0]), float(ends[i][1])) for i in range(len(STATISTICS))
              if ends[i] and ends[i][1] > ends[i][0]]
    s = F.col("statistics")
    terms = [rule.column(s).cast("double") for rule in rules]
    terms += [_scaled(s[i], low, high) for i, low, high in linear]
    if not terms:
        p = n[1] / total
        return RuleEnsemble(float(np.log(p / (1 - p))), (), ())
    design = saved(data.select(F.array(*terms).alias("x"), "label"), "quality-design").select(
        array_to_vector("x").alias("features"), "label"
    )
    lasso = LogisticRegression(
        regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=True
    ).fit(design)
    w = lasso.coefficients.toArray()
    return RuleEnsemble(
        float(lasso.intercept),
        tuple((r, float(x)) for r, x in zip(rules, w) if x),
        tuple((*b, float(x)) for b, x in zip(linear, w[len(rules):]) if x),
    )


def _marks(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("bigint"), "quality").where(
        "doc_id IS NOT NULL AND quality IS NOT NULL"
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def fit_sample(docs: DataFrame, labels: DataFrame, learn: Column,
               fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """The ensemble of :func:`fit_documents`, with statistics of the fitting
    rows only: the sample is chosen by id first, and its ids, about
    ``fit_rows`` of them, are broadcast to the documents."""
    few = docs.select(F.col("doc_id").cast("bigint"), F.col("text")).where(learn)
    known = few.select("doc_id").join(_marks(labels), "doc_id").where(F.col("quality").isin(0, 1))
    known = saved(known.groupBy("doc_id", "quality").agg(F.count("*").alias("rows")), "quality-known")
    total = known.agg(F.sum("rows")).first()[0] or 0
    chosen = known.where(_chosen(fit_rows, total)).select("doc_id", "quality")
    rows = with_statistics(few.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"))
    return fit(rows.select("doc_id", "statistics").join(chosen, "doc_id"), 2 * fit_rows)


def _chosen(fit_rows: int, total: int) -> Column:
    """Whether a row is in the sample of about ``fit_rows`` of ``total``."""
    scale = 1 << 20
    share = min(1.0, fit_rows / total) if total else 1.0
    return F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(scale)) < scale * share


def fit_documents(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple:
    """(ensemble, saved doc_id and statistics of all rows): learned from the
    labelled rows of ``docs`` where ``learn`` (of doc_id) holds."""
    few = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    stats = saved(with_statistics(few).select("doc_id", "statistics"), "quality-statistics")
    return fit(stats.where(learn).join(_marks(labels), "doc_id")), stats
