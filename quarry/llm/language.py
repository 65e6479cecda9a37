"""Language identification with character models.

One interpolated Kneser-Ney model of order ORDER per language over the
letters of a word: the word is lower-cased and put between start and end
symbols, and every symbol is predicted from the three before it. The models
are stored together as sorted arrays of n-gram hashes with one column of log
probabilities per language, so one binary search serves all languages. A text
goes to the language of lowest cross-entropy per symbol over its letter runs
(each distinct run of a batch is scored once, whatever its number).

Fitting reads a bounded sample of the labelled rows: about FIT_DOCS documents
a language, whole texts, chosen by a hash of the id, and about
CALIBRATION_DOCS others a language that set the score and the rejection
threshold. A language of fewer than FEW rows is fitted on all of them, and has
the threshold of the others. Everything else reads all rows.

Calibrated rejection: a prediction is accepted unless its cross-entropy is
above what the calibration documents of that language showed (their quantile
QUANTILE, so that one odd text does not set it), by a margin. ``score`` is the posterior of the language at the calibrated
temperature, lowered for rejected texts.

Defined results: null texts, and texts without a letter, are ``und`` with
score 0 and not accepted; equal scores go to the first language by name; rows
with a null id are predicted and never learned from; with no labelled row
every text is ``und``. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_batches, mix, sliced, prepare

ORDER = 4
FIT_DOCS = 2000  # labelled documents a language whose texts are counted, about
CALIBRATION_DOCS = 500  # further ones for temperature and threshold, about
MARGIN = 2.0  # times the quantile of the cross-entropy of a language's calibration texts
QUANTILE = 0.99
CALIBRATION_SIDE = 0.2  # share of the labelled rows that can calibrate
FEW = 20  # languages of fewer labelled rows are fitted on all of them
PAD, END = 1, 2  # symbols that are no letters
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"

_POWER = mix(np.arange(1, ORDER + 1, dtype=np.uint64)) | np.uint64(1)
_alpha: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _alpha:
        flags = [chr(c).isalpha() for c in range(0x110000)]
        flags[0xD800:0xE000] = [False] * 0x800
        _alpha.append(np.array(flags))
    return _alpha[0]


def gram_hash(symbols: np.ndarray) -> np.ndarray:
    """Hashes of the rows of an (n, k) array of symbols, k <= ORDER."""
    k = symbols.shape[1]
    h = np.full(len(symbols), k, np.uint64)
    for j in range(k):
        h += mix(symbols[:, j].astype(np.uint64) + np.uint64(1)) * _POWER[j]
    return mix(h)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, where) of each wanted key in a sorted array."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)), at


@dataclass
class Models:
    languages: list[str]
    keys: list[np.ndarray]  # per order 1..ORDER: sorted hashes of the n-grams
    logp: list[np.ndarray]  # (n-gram, language) log probability
    context_keys: list[np.ndarray]  # per order: sorted hashes of the contexts
    log_backoff: list[np.ndarray]
    log_unseen: float  # log probability of a symbol no language has
    temperature: float = 1.0
    limit: np.ndarray | None = None  # per language, highest accepted cross-entropy

    def windows(self, symbols: np.ndarray) -> np.ndarray:
        """(window, language) log probability of the last symbol of each row."""
        out = np.zeros((len(symbols), len(self.languages)))
        left = np.arange(len(symbols))
        for k in range(ORDER, 0, -1):
            part = symbols[left][:, ORDER - k:]
            found, at = _find(self.keys[k - 1], gram_hash(part))
            out[left[found]] += self.logp[k - 1][at[found]]
            left, part = left[~found], part[~found]
            if not len(left):
                return out
            if k > 1:
                seen, at = _find(self.context_keys[k - 1], gram_hash(part[:, :-1]))
                out[left[seen]] += self.log_backoff[k - 1][at[seen]]
        out[left] += self.log_backoff[0][0] + self.log_unseen
        return out


def build(counts: pd.DataFrame) -> Models:
    """Models from the columns lang, gram (ORDER symbols), n."""
    languages = sorted(counts.lang.unique())
    text = "".join(counts.gram)
    grams = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(-1, ORDER).astype(np.int64)
    lang = counts.lang.map({x: i for i, x in enumerate(languages)}).to_numpy()
    n_symbols = len(np.unique(grams)) + 1
    m = Models(languages, [], [], [], [], -float(np.log(n_symbols)))

    levels = []  # per order, highest first: grams, language, count
    now, who, n = grams, lang, counts.n.to_numpy().astype(float)
    for k in range(ORDER, 0, -1):
        levels.append((now, who, n))
        if k > 1:  # continuation counts: distinct symbols on the left
            rows = np.column_stack([who, now[:, 1:]])
            rows, n = np.unique(rows, axis=0, return_counts=True)
            who, now, n = rows[:, 0], rows[:, 1:], n.astype(float)
    lower = None
    for now, who, n in reversed(levels):
        k, count = now.shape[1], len(languages)
        keys, first, which = np.unique(gram_hash(now), return_index=True, return_inverse=True)
        c = np.zeros((len(keys), count))
        c[which, who] = n
        once, twice = (n == 1).sum(), (n == 2).sum()
        d = once / (once + 2 * twice) if once and twice else 0.5
        ctx = gram_hash(now[first][:, :-1]) if k > 1 else np.zeros(len(keys), np.uint64)
        ctx_keys, of = np.unique(ctx, return_inverse=True)
        total, types = np.zeros((len(ctx_keys), count)), np.zeros((len(ctx_keys), count))
        np.add.at(total, of, c)
        np.add.at(types, of, c > 0)
        weight = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
        if lower is None:
            below = np.full((len(keys), count), 1.0 / n_symbols)
        else:
            found, at = _find(lower[0], gram_hash(now[first][:, 1:]))
            assert found.all()
            below = lower[1][at]
        p = np.maximum(c - d, 0) / np.maximum(total[of], 1) + weight[of] * below
        lower = (keys, p)
        m.keys.append(keys)
        m.logp.append(np.log(p).astype(np.float32))
        m.context_keys.append(ctx_keys)
        m.log_backoff.append(np.log(weight).astype(np.float32))
    return m


def letter_runs(texts: list[str]):
    """Distinct lower-cased letter runs of a batch: (symbols of all, their
    starts, their lengths), and per occurrence (text, distinct run)."""
    code = np.frombuffer(" ".join(texts).lower().encode("utf-32-le", "replace"), np.uint32)
    # lower-casing may change lengths, so texts are told apart by counting on their own
    sizes = np.array([len(t.lower()) for t in texts]) + 1
    ends = np.cumsum(sizes)
    if len(code) != ends[-1] - 1:  # a context-dependent case mapping across texts
        low = " ".join(t.lower() for t in texts)
        code = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[code]
    edge = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lens = stops - starts
    symbols = code[letter].astype(np.int64)
    at = np.cumsum(lens) - lens
    if not len(at):
        return symbols, at, lens, at, at
    place = np.arange(len(symbols)) - np.repeat(at, lens)
    powers = np.cumprod(np.full(int(lens.max()), 0x9E3779B97F4A7C55, np.uint64))
    term = mix(symbols.astype(np.uint64)) * powers[place]
    key = mix(np.add.reduceat(term, at) + lens.astype(np.uint64))
    which, found = pd.factorize(key)
    one = np.empty(len(found), np.int64)
    one[which[::-1]] = np.arange(len(which))[::-1]
    return symbols, at[one], lens[one], np.searchsorted(ends, starts, side="right"), which


def run_windows(symbols: np.ndarray, at: np.ndarray, lens: np.ndarray):
    """(windows of ORDER symbols, run of each): one per symbol and end."""
    size = lens + ORDER  # pads, letters, end
    first = np.cumsum(size) - size
    flat = np.full(int(size.sum()), PAD, np.int64)
    inside = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    flat[np.repeat(first + ORDER - 1, lens) + inside] = symbols[np.repeat(at, lens) + inside]
    flat[first + size - 1] = END
    run = np.repeat(np.arange(len(lens)), lens + 1)
    begin = np.arange(len(run)) - np.repeat(np.cumsum(lens + 1) - lens - 1, lens + 1)
    return flat[(np.repeat(first, lens + 1) + begin)[:, None] + np.arange(ORDER)], run


def cross_entropies(m: Models, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """((text, language) cross-entropy in nats a symbol, symbols a text)."""
    n = len(texts)
    total, count = np.zeros((n, len(m.languages))), np.zeros(n)
    parts = [(i, t[a:a + CHUNK_CHARS]) for i, t in enumerate(texts)
             for a in range(0, len(t), CHUNK_CHARS)]
    for group in byte_batches(parts, lambda p: len(p[1]), CHUNK_CHARS):
        rows = np.array([i for i, _ in group])
        symbols, at, lens, text, which = letter_runs([t for _, t in group])
        if not len(at):
            continue
        windows, run = run_windows(symbols, at, lens)
        logp = np.zeros((len(lens), len(m.languages)))
        for lo in range(0, len(windows), 1 << 20):
            s = slice(lo, lo + (1 << 20))
            p = m.windows(windows[s])
            for j in range(p.shape[1]):
                logp[:, j] += np.bincount(run[s], p[:, j], len(lens))
        at_row = rows[text]
        for j in range(logp.shape[1]):
            total[:, j] += np.bincount(at_row, logp[which, j], n)
        count += np.bincount(at_row, lens[which] + 1.0, n)
    return -total / np.maximum(count, 1)[:, None], count


def posterior(m: Models, entropy: np.ndarray, count: np.ndarray, temperature: float):
    """Posterior of each language. Evidence grows with the square root of the
    length: neighbouring symbols are no independent draws."""
    evidence = -(entropy - entropy.min(axis=1, keepdims=True)) * np.sqrt(count)[:, None]
    p = np.exp(evidence * temperature)
    return p / p.sum(axis=1, keepdims=True)


def predict(m: Models, texts: list[str | None]):
    """(language or und, score, accepted, cross-entropy) of each text."""
    texts = [t or "" for t in texts]
    if not m.languages:
        n = len(texts)
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool), np.zeros(n)
    entropy, count = cross_entropies(m, texts)
    best = entropy.argmin(axis=1)
    h = entropy[np.arange(len(best)), best]
    score = posterior(m, entropy, count, m.temperature)[np.arange(len(best)), best]
    known = count > 0
    accepted = known & (h <= m.limit[best])
    score = np.where(accepted, score, score * m.limit[best] / np.maximum(h, 1e-9))
    score = np.where(known, np.clip(score, 0.0, 1.0), 0.0)
    languages = [m.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return languages, score, accepted, np.where(known, h, 0.0)


def _calibrate(m: Models, lang: list[str], entropy: np.ndarray, count: np.ndarray) -> None:
    right = np.array([m.languages.index(x) if x in m.languages else -1 for x in lang], int)
    ok = (right >= 0) & (count > 0)
    entropy, count, right = entropy[ok], count[ok], right[ok]
    best = entropy.argmin(axis=1) if len(entropy) else np.empty(0, int)
    own = entropy[np.arange(len(right)), right] if len(entropy) else np.empty(0)
    hit = best == right
    highest = np.quantile(own[hit], QUANTILE) if hit.any() else -m.log_unseen
    m.limit = np.array([
        MARGIN * (np.quantile(own[hit & (right == j)], QUANTILE)
                  if (hit & (right == j)).any() else highest)
        for j in range(len(m.languages))
    ])
    if len(entropy):
        def loss(t):
            p = posterior(m, entropy, count, t)[np.arange(len(right)), right]
            return -np.log(np.clip(p, 1e-9, 1)).mean()
        m.temperature = min((2.0 ** e for e in range(-3, 4)), key=loss)


def fit(
    docs: DataFrame, learn: Column, fit_docs: int = FIT_DOCS,
    calibration_docs: int = CALIBRATION_DOCS,
) -> Models:
    """Models from the rows of ``docs`` where ``learn`` holds and lang is not
    null."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where(
        learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Models([], [], [], [], [], 0.0)
    spark = docs.sparkSession
    share = spark.createDataFrame(
        [(k, min(1.0, fit_docs / n if n < FEW else fit_docs / ((1 - CALIBRATION_SIDE) * n)),
          min(1.0, calibration_docs / (CALIBRATION_SIDE * n)), n < FEW)
         for k, n in sizes.items()],
        "lang string, fit_share double, calibration_share double, few boolean",
    )
    scale = 1 << 20
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(scale)) / F.lit(float(scale))
    side = ~F.col("few") & (
        F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(scale)) < CALIBRATION_SIDE * scale)
    sample = rows.join(F.broadcast(share), "lang").select(  # one row a language
        "lang", "text",
        F.when(side, place < F.col("calibration_share")).otherwise(False).alias("calibrates"),
        F.when(~side, place < F.col("fit_share")).otherwise(False).alias("fits"),
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for a in range(0, len(text or ""), CHUNK_CHARS):
                    symbols, at, lens, _, which = letter_runs([text[a:a + CHUNK_CHARS]])
                    words = [symbols[i:i + k].astype("<u4").tobytes().decode("utf-32-le")
                             for i, k in zip(at, lens)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()),
                         pa.array(np.bincount(which, minlength=len(words)).astype(np.int64))],
                        names=["lang", "word", "n"],
                    )

    words = sample.where("fits").select("lang", "text").mapInArrow(
        runs, "lang string, word string, n bigint"
    ).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    padded = F.concat(F.lit(chr(PAD) * (ORDER - 1)), F.col("word"), F.lit(chr(END)))
    starts = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    grams = words.select("lang", "n", padded.alias("p"), starts.alias("i")).select(
        "lang", F.col("p").substr(F.col("i"), F.lit(ORDER)).alias("gram"), "n"
    )
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return Models([], [], [], [], [], 0.0)
    m = build(counts)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                entropy, count = cross_entropies(m, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(entropy), pa.list_(pa.float64())),
                     pa.array(count)], names=["lang", "entropy", "count"],
                )

    seen = sample.where("calibrates").select("lang", "text").mapInArrow(
        measured, "lang string, entropy array<double>, count double"
    ).toPandas()
    entropy = np.stack(seen.entropy.to_numpy()) if len(seen) else np.empty((0, len(m.languages)))
    _calibrate(m, list(seen.lang), entropy, seen["count"].to_numpy())
    return m


def identify(docs: DataFrame, m: Models) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row, in its place."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(m)  # bounded by the fitting sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                lang, score, accepted, _ = predict(shared.value, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score),
                     pa.array(accepted)], names=["doc_id", "lang_pred", "score", "accepted"],
                )

    few = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return few.mapInArrow(run, "doc_id bigint, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, m: Models, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose prediction is accepted, all columns."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(m)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text_column):
                texts = part.column(at).to_pylist()
                yield part.filter(pa.array(predict(shared.value, texts)[2]))

    return docs.mapInArrow(run, docs.schema)
