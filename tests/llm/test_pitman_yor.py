from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, queries
from quarry.llm import pitman_yor as py
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def base_scores(rows):
    """{id: (held out, n_tokens, n_known, N, base score)}"""
    c = Counter()
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            c.update([*words(t), ""])
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in rows:
        tok = [*words(t), ""]
        s = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok)
        out[i] = (held[i], len(tok), sum(c[w] > 0 for w in tok), n, s)
    return out


@pytest.mark.parametrize("head", [0, 200, 500_000])
def test_query(spark, monkeypatch, head):
    monkeypatch.setattr(py, "HEAD_WORDS", head)
    want = base_scores([(d["doc_id"], d["text"]) for d in documents()])
    got = {r.doc_id: r for r in queries.op10_lm_scoring(spark, SF).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        held, n, known, total, base = want[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    if head:
        out = [r for r in got.values() if r.held_out]
        assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_add_up(spark):
    docs = [(i, t) for i, t in enumerate(["a b a c", "a b b d e", "", "c a a b", "f g h a"] * 3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for classes in (2, 1000):
        old, py.CLASSES = py.CLASSES, classes
        try:
            m, table = py.fit(df, F.lit(True))
        finally:
            py.CLASSES = old
        assert np.allclose((10.0 ** m.log_class.astype(float)).sum(axis=1), 1, atol=1e-4)
        counts = {r.word: r.n for r in table.collect() if r.word}
        top = sorted(counts, key=lambda w: (-counts[w], w))[:classes]
        rare = np.array([0, *(n for w, n in counts.items() if w not in top)])
        # what each word has less by its tables is what all have as new words
        assert (10.0 ** m.rare.log10(rare)).sum() == pytest.approx(1, abs=1e-6)


def test_score_is_the_product_over_tokens(spark):
    docs = [(1, "a b a"), (2, "a c"), (3, "B zz"), (4, None), (4, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    m, table = py.fit(df, F.col("doc_id") != 3)
    got = {r.doc_id: r.score for r in py.score(df, m, table).collect()}
    # classes by falling count, then by word: a, b, c
    klass = {"a": 2, "b": 3, "c": 4, "": py.END}
    for i, text in docs:
        before, s = m.log_class.shape[0] - 1, 0.0
        for w in [*words(text), ""]:
            k = klass.get(w, py.RARE)
            s += m.log_class[before, k] + (m.rare.log10(np.array([0]))[0] if k == py.RARE else 0)
            before = k
        assert got[i] == pytest.approx(s, rel=1e-5)


@pytest.mark.parametrize("head", [0, 4, 500_000])
def test_every_word_is_a_context(spark, monkeypatch, head):
    monkeypatch.setattr(py, "CLASSES", 2)
    monkeypatch.setattr(py, "HEAD_WORDS", head)
    # p goes before q, r before s, all of one count
    docs = [(i, t) for i, t in enumerate(["a a b p q a", "b r s a", "a b a", "p q", "r s"] * 6)]
    vocabulary = ["a", "b", "p", "q", "r", "s", "never"]
    docs += [(1000, "p q"), (1001, "p s"), (1002, "r s"), (1003, "r q")]
    # "zz" was never learned from, so what follows it has the parents' probability
    docs += [(2000 + i, f"p {x}") for i, x in enumerate(vocabulary)] + [(3000, "zz p")]
    docs += [(4000 + i, f"zz {x}") for i, x in enumerate(vocabulary)] + [(3001, "zz"), (3002, "p")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    m, table = py.fit(df, F.col("doc_id") < 1000)
    got = {r.doc_id: r.score for r in py.score(df, m, table).collect()}
    assert got[1000] > got[1001] + 0.5 and got[1002] > got[1003] + 0.5
    # P(. | p) of every word, of the end and of the unknown word
    n = {r.word: r.n for r in table.collect()}
    klass = {w: 2 + i for i, w in enumerate(
        sorted((w for w in n if w), key=lambda w: (-n[w], w))[:2 if head else 0])} | {"": py.END}
    base = {w: m.log_class[py.RARE, klass.get(w, py.RARE)] + (
        0 if w in klass else m.rare.log10(np.array([n.get(w, 0)]))[0]) for w in [*vocabulary, ""]}
    first = got[3001] - base[""]  # P(zz | start)
    ends = {x: got[4000 + i] - first - base[x] for i, x in enumerate(vocabulary)}
    after_p = got[3002] - ends["p"]  # P(p | start)
    total = 10.0 ** ends["p"] + sum(
        10.0 ** (got[2000 + i] - after_p - ends[x]) for i, x in enumerate(vocabulary))
    assert total == pytest.approx(1, abs=1e-4)  # class probabilities have single precision


def seated_by_hand(texts, m, counts, classes):
    """log10 P of texts where every pair that touches a rare word was learned
    once: each has one table, so nothing is sampled."""
    seen = Counter()
    klass = {w: 2 + i for i, w in enumerate(classes)} | {"": py.END}
    for t in texts:
        w = [None, *words(t), ""]
        seen.update((a, b) for a, b in zip(w, w[1:])
                    if b not in klass or (a is not None and a not in klass))
    assert set(seen.values()) == {1}
    followers = Counter(a for a, _ in seen)

    def log10(text):
        total, before = 0.0, None
        for w in [*words(text), ""]:
            k = klass.get(w, py.RARE)
            after = m.log_class.shape[0] - 1 if before is None else klass.get(before, py.RARE)
            rare = m.rare.log10(np.array([counts.get(w, 0)]))[0] if k == py.RARE else 0.0
            if k != py.RARE and after != py.RARE:
                total += m.log_class[after, k]
            else:
                base = rare + (m.log_class[after, k] if after == py.RARE else 0.0)
                c = t = followers[before]
                own = (1 - 0.5) * ((before, w) in seen) / (py.STRENGTH + c)
                p = own + (py.STRENGTH + 0.5 * t) / (py.STRENGTH + c) * 10.0**base
                total += math.log10(p) + (m.log_class[after, k] if after != py.RARE else 0.0)
            before = w
        return total

    return log10


@pytest.mark.parametrize("apart, settings", [
    (False, {"PART_TOKENS": 3, "WIDE": 0, "WIDE_BLOB": 1, "HOT": 1}),
    (False, {"HEAD_WORDS": 5, "PART_TOKENS": 3}), (True, {}), (True, {"HOT": 1}),
])
def test_scores_against_seating_by_hand(spark, monkeypatch, settings, apart):
    monkeypatch.setattr(py, "CLASSES", 2)
    for k, v in settings.items():
        monkeypatch.setattr(py, k, v)
    texts = ["a b a b c d", "b a a e f g a", "a b h b b e c a", "a b b a i d b g", "a a"]
    more = ["a c", "zz c d yy yy yy", "f g", "", "A b C d", "a b c d", "c zz zz"]
    docs = list(enumerate([*texts, *more, more[1]]))
    df = spark.createDataFrame([*docs, docs[0], docs[6]], "doc_id bigint, text string")
    df = df.where("doc_id <> 0").union(df.where("doc_id = 0").limit(1)).repartition(3)
    learn = F.col("doc_id") < len(texts)
    m, table = py.fit(df, learn)
    counts = {r.word: r.n for r in table.collect()}
    by_hand = seated_by_hand(texts, m, counts, ["a", "b"])
    rows = py.score(df, m, table, None if apart else learn).collect()
    assert len(rows) == len(docs) + 1
    for r in rows:
        assert r.score == pytest.approx(by_hand(docs[r.doc_id][1]), abs=1e-5)
    assert (m.hot_value is not None and bool((m.hot_value != 0).any())) == ("HOT" in settings)


@pytest.mark.parametrize("settings", [
    {"PART_TOKENS": 20, "GROUP_TOKENS": 2, "WIDE": 0, "WIDE_BLOB": 1, "HOT": 1},
    {"HEAD_WORDS": 5, "GROUP_TOKENS": 3},
])
def test_groups_of_a_part_score_as_by_hand(spark, monkeypatch, settings):
    test_scores_against_seating_by_hand(spark, monkeypatch, settings, False)


def test_a_part_is_seated_group_by_group(monkeypatch):
    # 24 blobs of one part; no seating gets more rows than its group has
    n, groups, texts = 3000, 8, 50
    rng = np.random.default_rng(3)
    empty = np.empty(0, np.uint64)
    m = py.Model(10**6, 10**5, 1, 1, empty, empty, empty, empty, np.zeros((3, 2)), None)
    blobs, want = [], np.zeros(24 * texts)
    for i in range(24):
        u = rng.integers(1, 400, n).astype(np.uint64) | py.TOP
        w = rng.integers(1, 90, n).astype(np.uint64) | py.TOP
        text = rng.integers(0, texts, n).astype(np.uint32)
        place = (py.mix(u) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((w, u, place))
        one = np.ones(n, np.uint32)
        keys = [np.arange(texts) + i * texts, np.zeros(texts, np.int64),
                np.zeros(texts, np.int32), np.zeros(texts, np.uint8)]
        blobs += py._blobs(place[order], groups, [x[order] for x in (u, w, one, one, one, text)], keys)
        want[i * texts:][:texts] = np.bincount(text, minlength=texts)
    sizes, pairs = [], py._Pairs
    monkeypatch.setattr(py, "_Pairs", lambda m, u, *more: sizes.append(len(u)) or pairs(m, u, *more))
    got = pa.Table.from_batches(list(py._settled(m, pa.Table.from_batches(blobs)))).to_pandas()
    assert sum(sizes) == 24 * n and len(sizes) == groups and max(sizes) < 24 * n / 4
    assert (got.kind == py.SUMS).all() and sorted(got.doc_id) == list(range(24 * texts))
    assert (got.sort_values("doc_id").known.to_numpy() == want).all()


def test_a_context_of_many_followers_is_split_over_tasks(spark, monkeypatch):
    # one context with a third of all pairs: dealt by its followers, its values
    # are those of one restaurant up to the sampling of tables. Two ways of
    # dealing draw different samples, so they tell how far samples differ
    monkeypatch.setattr(py, "CLASSES", 1)
    texts = [f"p w{i % 400} p w{i % 7} x" for i in range(1200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(py, "WIDE", 10**9)
    m, table = py.fit(df, F.lit(True))
    assert m.slots > 1
    got = []
    for part in (10**9, 500, 700):
        monkeypatch.setattr(py, "PART_TOKENS", part)
        by_id = {r.doc_id: r.score for r in py.score(df, m, table, F.lit(True)).collect()}
        got.append(np.array([by_id[i] for i in range(1200)]))
    whole, split, other = got
    noise = np.sqrt(np.mean((split - other) ** 2))
    assert 0 < noise < 0.1
    for x in (split, other):
        assert np.sqrt(np.mean((whole - x) ** 2)) < 1.5 * noise
        assert abs(whole.mean() - x.mean()) < 0.01
        assert np.abs(whole - x).max() < 6 * noise


def test_seating_follows_the_restaurant_process():
    # mean tables of c customers with nothing else in the restaurant, against
    # seating customer by customer
    rng = np.random.default_rng(0)
    c = np.full(4000, 40)
    got = py.seat(c, np.full(4000, 0.3), np.full(4000, 5.0), 0.6, rng).mean()
    slow = []
    for _ in range(2000):
        t = 1
        for n in range(1, 40):
            pull = (1 + 0.6 * 5) * 0.3
            t += rng.random() < pull / (pull + n - 0.6 * t)
        slow.append(t)
    assert got == pytest.approx(np.mean(slow), rel=0.03)
    many = py.seat(np.array([10**9, 1, 0]), np.full(3, 0.1), np.full(3, 9.0), 0.5, rng)
    assert 1 < many[0] < 1000 and many[1] == 1 and many[2] == 0


def test_odd_texts(spark):
    df = odd_documents(spark)
    m, table = py.fit(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    got = py.score(df, m, table).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted(
        (str(r.doc_id), len(words(r.text)) + 1) for r in df.collect())
    rows = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    want = base_scores(list(rows.items()))
    # (base_scores counts a repeated row once; the odd table repeats one, so
    # only finiteness is asked for here)
    assert set(want) == set(rows) and all(math.isfinite(r.score) for r in got)


def test_nothing_to_learn_from(spark):
    df = odd_documents(spark)
    m, table = py.fit(df, F.lit(False))
    assert {(r.score, r.n_known) for r in py.score(df, m, table).collect()} == {(0.0, 0)}


def test_empty_table(spark):
    df = empty_documents(spark)
    assert py.score(df, *py.fit(df, F.lit(True))).collect() == []


# --- the work of a batch ---


@pytest.mark.parametrize("texts", [
    [], [""], ["A"], ODD_TEXTS, ["aB " * 9, "", "\x00 a\x00 a", "@[`{ AZ\x85é", "x" * 70 + " " + "x" * 71],
    ["a" * n + "b" * (n % 3) for n in range(80)] * 2])
def test_words_told_apart_eight_bytes_at_a_time(texts):
    w = common.lower_words(*common.text_buffers(pa.array(texts, pa.string())))
    want = [words(t) for t in texts]
    names = w.strings(np.arange(len(w.key))).to_pylist()
    assert names == list(dict.fromkeys(x for each in want for x in each))
    assert [names[i] for i in w.which] == [x for each in want for x in each]
    assert np.diff(w.offsets).tolist() == [len(x) for x in want]
    for name, key, check in zip(names, w.key, w.check):
        data = np.frombuffer(name.encode(), np.uint8)
        one = common.string_hashes(data, np.array([0]), np.array([len(data)]))
        assert (one[0][0], one[1][0]) == (key, check)


def test_only_distinct_words_are_hashed_byte_by_byte(monkeypatch):
    hashed, hashes = [], common.string_hashes
    monkeypatch.setattr(common, "string_hashes", lambda data, *more: hashed.append(
        len(data)) or hashes(data, *more))
    common.lower_words(*common.text_buffers(pa.array(["many words " * 3000])))
    assert sum(hashed) == len("manywords")


def test_pairs_in_order_also_where_halves_of_hashes_meet():
    rng = np.random.default_rng(5)
    for top in (0, 1 << 63, (1 << 63) + (7 << 32)):
        u, w = (rng.integers(0, 9, 500).astype(np.uint64) + np.uint64(top) for _ in range(2))
        w[::3] = rng.integers(0, 1 << 63, len(w[::3])).astype(np.uint64) | py.TOP
        place = rng.integers(0, 3, 500)
        for order, want in ((py._order(u, w), (w, u)),
                            (py._order_by_place(place, u, w), (w, u, place))):
            assert sorted(order) == list(range(500))
            for x in want:
                assert (x[order] == x[np.lexsort(want)]).all()


def test_hashes_are_found_by_their_top_bits():
    rng = np.random.default_rng(6)
    keys = np.sort(np.append(rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2),
                             np.arange(40, dtype=np.uint64)))
    find = py._Places(keys)
    wanted = np.concatenate([keys, keys + np.uint64(1), [np.uint64(2**64 - 1)]])
    at = {int(k): i for i, k in reversed(list(enumerate(keys)))}
    assert find(wanted).tolist() == [at.get(int(k), -1) for k in wanted]


def test_packed_columns_leave_out_zero_planes(monkeypatch):
    raw, compress = [], pa.compress
    monkeypatch.setattr(pa, "compress", lambda x, **k: raw.append(len(x)) or compress(x, **k))
    columns = [np.arange(300).astype(k) for k in py._PAIRS[:3]] + [
        np.zeros(300, np.uint32), np.ones(300, np.uint32), np.full(300, py.NO_TEXT)]
    back = py._unpacked(pa.py_buffer(py._packed(columns)), 300, py._PAIRS)
    assert all((a == b).all() and b.dtype == k for a, b, k in zip(columns, back, py._PAIRS))
    assert raw == [300 * (2 + 2 + 2 + 0 + 1 + 4)]  # 32 bytes a row with all planes
    signed = [np.array([-1, 0, 5]), np.array([7, -9, 1]), np.array([-3, 2, 1], np.int32),
              np.zeros(3, np.uint8)]
    back = py._unpacked(pa.py_buffer(py._packed(signed)), 3, py._KEYS)
    assert all((a == b).all() for a, b in zip(signed, back))
    assert [len(x) for x in py._unpacked(pa.py_buffer(py._packed([np.empty(0)])), 0, py._KEYS)] == [0] * 4


def test_texts_of_a_blob_are_numbered():
    keys = [np.arange(900) + 50, np.zeros(900, np.int64), np.zeros(900, np.int32),
            np.zeros(900, np.uint8)]
    for n in (30, 3000):  # few and many rows a text
        text = np.random.default_rng(n).integers(0, 900, n).astype(np.uint32)
        text[::7] = py.NO_TEXT
        zero = np.zeros(n, np.uint32)
        payload, texts, own = py._blob([zero.astype(np.uint64), zero, zero, zero, zero, text], keys)
        back = py._unpacked(pa.py_buffer(payload), n, py._PAIRS)[5]
        doc = np.append(py._unpacked(pa.py_buffer(own), texts, py._KEYS)[0], -1)
        assert texts == len(set(text.tolist())) - 1
        assert (doc[np.minimum(back, texts)] == np.where(
            text == py.NO_TEXT, -1, text.astype(np.int64) + 50)).all()


def test_slices_are_even():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100] * 70)], names=["text"])
    assert [p.num_rows for p in py._slices(batch, 3000)] == [24, 23, 23]  # not 30, 30, 10
    assert sum(p.num_rows for p in py._slices(batch, 50)) == 70
    assert not list(py._slices(batch.slice(0, 0), 3000))


def test_customers_seated_one_by_one_draw_as_the_binomial():
    rng = np.random.default_rng(8)
    customers = np.minimum(rng.zipf(1.5, 400), 5000)
    base, tables = 10.0 ** -rng.uniform(0, 6, 400), rng.integers(0, 500, 400).astype(float)
    t, draw = np.minimum(customers, 1).astype(float), np.random.default_rng(9)
    pull, n = (py.STRENGTH + 0.7 * tables) * base, 1
    while (on := np.flatnonzero(customers > n)).size:
        step = 1 if n < py.EXACT else n // 10
        some = np.minimum(step, customers[on] - n)
        old = np.maximum(n + (some - 1) / 2 - 0.7 * t[on], 1e-9)
        t[on] += draw.binomial(some, pull[on] / (pull[on] + old))
        n += step
    assert (py.seat(customers, base, tables, 0.7, np.random.default_rng(9)) == t).all()
