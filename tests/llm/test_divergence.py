from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import divergence, queries
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string"


def brute(rows, min_docs=30, top=50):
    """rows: (text, lang, source)."""
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups[lang].add(source)
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in df[lang].items() if n >= min_docs}
        own = {s: Counter({t: n for t, n in count[lang, s].items() if t in kept}) for s in sources}
        total = sum(own.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s in sources:
            pair = [(sum(abs(p(own[s], t) - p(own[o], t)) for t in kept), o)
                    for o in sources if o != s]
            term = [(p(own[s], t) - p(total, t), t) for t in kept
                    if own[s][t] and p(own[s], t) > p(total, t)]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for r, (v, item) in enumerate(items[:top] if part == "term" else items):
                    out.append((lang, s, part, item, v, r + 1))
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_query_equals_brute_force(spark):
    want = brute([(d["text"], d["lang"], d["source"]) for d in documents()])
    assert got(queries.op12_source_divergence(spark, SF)) == want
    assert {w[2] for w in want} == {"pair", "term"}


@pytest.mark.parametrize("min_docs", [1, 2])
def test_odd_documents(spark, min_docs):
    df = odd_documents(spark).withColumn("term", F.lit("clash")).withColumn("p", F.lit(1))
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert got(divergence.audit(df, min_docs, 3)) == brute(rows, min_docs, 3)


def test_empty_and_groups_without_terms(spark):
    assert got(divergence.audit(empty_documents(spark))) == []
    rows = [(1, "12 34", "en", "a"), (2, None, "en", "b"), (3, "few words", "en", None),
            (4, "", None, "a"), (5, "x", None, None)]
    found = got(divergence.audit(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute([r[1:] for r in rows])
    assert {(f[2], f[4]) for f in found} == {("pair", 0)}


def test_sources_of_many_sizes_ties_and_repeats(spark):
    rng = random.Random(2)
    words = ["Alpha", "beta", "gamma", "naïve", "日本", "Éa", "éa", "z", "y", "x"]
    rows = []
    for i in range(600):
        source = rng.choice(["big"] * 6 + ["b", "c", "d", "é", "Z", None])
        n = rng.choice([0, 1, 3, 40])
        rows.append((i, "-".join(rng.choices(words, range(10, 0, -1), k=n)), rng.choice("mn"),
                     source))
    rows += rows[:50]
    found = got(divergence.audit(spark.createDataFrame(rows, SCHEMA), 5, 4))
    assert found == brute([r[1:] for r in rows], 5, 4)


def test_long_texts_in_pieces_count_one_document(spark, monkeypatch):
    text = "Wort wort café " * 40
    data, offsets = divergence.text_buffers(divergence.pa.array([text]))
    monkeypatch.setattr(divergence, "SLICE", 13)
    terms, n = divergence._long_counts(data)
    assert dict(zip(terms, n)) == {"wort": 80, "café": 40}
    batch = divergence.pa.RecordBatch.from_arrays(
        [divergence.pa.array([x] * 1) for x in ("l", "s", text)], names=["lang", "source", "text"])
    out = [r for b in divergence._counted(iter([batch])) for r in b.to_pylist()]
    assert {(r["term"], r["n"], r["docs"]) for r in out} == {("wort", 80, 1), ("café", 40, 1)}


def test_counts_of_pieces_equal_whole_slices(monkeypatch):
    texts = [t or "" for t in ODD_TEXTS]
    pa = divergence.pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["l"] * len(texts)), pa.array([str(i % 3) for i in range(len(texts))]),
         pa.array(texts)], names=["lang", "source", "text"])

    def total():
        out = defaultdict(lambda: [0, 0])
        for b in divergence._counted(iter([batch])):
            for r in b.to_pylist():
                out[r["source"], r["term"]][0] += r["n"]
                out[r["source"], r["term"]][1] += r["docs"]
        return dict(out)

    whole = total()
    monkeypatch.setattr(divergence, "SLICE", 50)
    assert total() == whole


def test_shared_paths_are_walked_once():
    pa = divergence.pa
    entry = pa.struct([("source", pa.string()), ("p", pa.int64()), ("z", pa.int64())])
    a, b, c = ({"source": s, "p": p, "z": 1} for s, p in (("a", 5), ("b", 7), ("c", 9)))
    paths = [[a], [a, b], [a, b, c], [b, c]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["l"] * 4), pa.array(paths, pa.list_(entry)), pa.array([1, 2, 3, 4])],
        names=["lang", "path", "times"])
    rows = [r for x in divergence._walk(iter([batch])) for r in x.to_pylist()]

    def extra(x, y):
        return (abs(x["p"] - y["p"]) - abs(x["p"] - 1) - abs(1 - y["p"]))

    assert {(r["source"], r["other"]): r["value"] for r in rows if r["other"]} == {
        ("a", "b"): 5 * extra(a, b), ("a", "c"): 3 * extra(a, c), ("b", "c"): 7 * extra(b, c)}
    single = defaultdict(int)
    for r in rows:
        if not r["other"]:
            single[r["source"]] += r["value"]
    assert single == {"a": 6, "b": 9, "c": 7}


def test_share_is_exact_beyond_64_bits(spark):
    n, total, terms = 3_000_000_000_000_017, 7_000_000_000_000_003, 11
    row = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint")
    want = 1 + 10**9 * (n + 5) // (total + 5 * terms)
    assert row.select(divergence.share("n", "total", "terms")).first()[0] == want
