from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.llm import language, queries
from quarry.llm.common import crc_mod
from tests.llm.helpers import SF, documents, empty_documents, odd_documents


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op9_language_id(spark, SF).collect()}
    docs = {d["doc_id"]: d for d in documents()}
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in docs[i]["text"] or ""):
            assert r.lang_pred == "und"
    judged = [(r.lang_pred, docs[i]["lang"]) for i, r in got.items()
              if r.held_out and docs[i]["lang"]]
    assert np.mean([a == b for a, b in judged]) > 0.95


def brute_kn(counts, gram):
    """Interpolated Kneser-Ney by its textbook recursion, one language."""
    symbols = {c for g in counts for c in g}

    def level(k):
        if k == language.ORDER:
            return counts
        return Counter({h: n for h, n in Counter(g[1:] for g in set(level(k + 1))).items()})

    def p(g):
        if not g:
            return 1 / (len(symbols) + 1)
        c = level(len(g))
        ones, twos = (sum(v == x for v in c.values()) for x in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = {h: v for h, v in c.items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return p(g[1:])
        return max(c.get(g, 0) - d, 0) / total + d * len(same) / total * p(g[1:])

    return p(gram)


def test_probabilities_equal_the_recursion_and_add_up():
    words = ["banana", "bandana", "cabana", "an", "a", "ab", "nab"]
    counts = Counter()
    for w in words:
        s = chr(1) * 3 + w + chr(2)
        counts.update(s[i:i + 4] for i in range(len(s) - 3))
    frame = pd.DataFrame([("x", g, n) for g, n in counts.items()], columns=["lang", "gram", "n"])
    m = language.build(frame)
    symbols = sorted({c for g in counts for c in g})
    for context in (chr(1) * 3, "ban", "ana", "zzz", "bzn"):
        rows = np.array([[ord(c) for c in context + s] for s in symbols])
        got = np.exp(m.windows(rows)[:, 0])
        assert np.allclose(got, [brute_kn(counts, context + s) for s in symbols], rtol=1e-5)
        unseen = math.exp(m.windows(np.array([[ord(c) for c in context + "ß"]]))[0, 0])
        assert got.sum() + unseen == pytest.approx(1, abs=1e-4)


def test_entropy_of_a_text_is_the_mean_over_its_words():
    frame = pd.DataFrame([("a", "\x01\x01\x01x", 3), ("b", "\x01\x01\x01y", 2),
                          ("a", "\x01\x01x\x02", 3), ("b", "\x01\x01y\x02", 2)],
                         columns=["lang", "gram", "n"])
    m = language.build(frame)
    one, k = language.cross_entropies(m, ["x", "Y y"])
    both, n = language.cross_entropies(m, ["x Y, y!", "", "123"])
    assert n.tolist() == [6, 0, 0] and k.tolist() == [2, 4]
    assert np.allclose(both[0], (one[0] * 2 + one[1] * 4) / 6)


def test_chunks_do_not_matter(monkeypatch):
    frame = pd.DataFrame([("a", "\x01\x01\x01x", 3), ("b", "\x01\x01\x01y", 2)],
                         columns=["lang", "gram", "n"])
    m = language.build(frame)
    texts = ["x y " * 10, "", "ÀΣ x", "İ y", "ΑΣ"]
    whole = language.cross_entropies(m, texts)
    monkeypatch.setattr(language, "CHUNK_CHARS", 4)
    cut = language.cross_entropies(m, texts)
    assert np.allclose(whole[0], cut[0]) and (whole[1] == cut[1]).all()


def test_odd_texts(spark):
    df = odd_documents(spark).withColumn(
        "lang", F.when(F.col("doc_id") < 12, F.col("lang")))
    m = language.fit(df, crc_mod("doc_id", 4) != 2)
    got = language.identify(df, m).collect()
    assert len(got) == df.count()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in got:
        has_letter = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.lang_pred == ("en" if has_letter else "und")
        assert (r.score > 0) == has_letter


def test_nothing_to_learn_from(spark):
    df = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    m = language.fit(df, crc_mod("doc_id", 4) != 2)
    assert {r.lang_pred for r in language.identify(df, m).collect()} == {"und"}


def test_empty_table(spark):
    df = empty_documents(spark)
    assert language.identify(df, language.fit(df, F.lit(True))).collect() == []


def test_rejects_what_no_language_explains(spark):
    docs = documents()
    rows = [(d["doc_id"], d["text"], d["lang"]) for d in docs]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    m = language.fit(df, F.lit(True))
    lang, score, accepted, _ = language.predict(m, ["Ωмегa жщыъ ქართული " * 9, docs[1]["text"]])
    assert list(accepted) == [False, True] and score[0] < score[1]


def test_sample_sizes_and_small_languages(spark, monkeypatch):
    rows = [(i, f"some words of text number {i}", "en") for i in range(1000)]
    rows += [(5000 + i, f"single {'abcdefghijklmnopqrst'[i] * 3}", f"l{i:02}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    seen = []
    calibrate = language._calibrate
    monkeypatch.setattr(language, "_calibrate", lambda m, lang, *rest: (
        seen.extend(lang), calibrate(m, lang, *rest)))
    m = language.fit(df, F.lit(True), calibration_docs=100)
    assert m.languages == sorted({r[2] for r in rows})
    assert 70 < len(seen) < 130 and set(seen) == {"en"}


def test_one_odd_text_does_not_set_the_limit():
    m = language.Models(["a", "b"], [], [], [], [], -5.0)
    own = np.append(np.full(400, 1.0), 4.9)
    entropy = np.column_stack([own, np.full(401, 5.0)])
    language._calibrate(m, ["a"] * 401, entropy, np.full(401, 30.0))
    assert m.limit[0] == pytest.approx(language.MARGIN)
