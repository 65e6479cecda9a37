from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import bpe, queries, tokens
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents

PATH = tokens.tokenizer_path()


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    t = tokens.load(PATH)
    out = Counter()
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        out[i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)] += 1
    return out


@pytest.mark.parametrize("head", [0, 300, 2_000_000])
def test_round_trip_equals_the_library(spark, monkeypatch, head):
    monkeypatch.setattr(bpe, "HEAD_WORDS", head)
    got = Counter(tuple(r) for r in queries.op8_bpe_codec(spark, SF).collect())
    assert got == expected((d["doc_id"], d["text"]) for d in documents())


@pytest.mark.parametrize("head", [0, 2_000_000])
def test_odd_texts(spark, monkeypatch, head):
    monkeypatch.setattr(bpe, "HEAD_WORDS", head)
    df = odd_documents(spark).withColumn("ids", F.lit("clash"))
    got = Counter(tuple(r) for r in queries.round_trip(df).collect())
    assert got == expected((r.doc_id, r.text) for r in df.collect())


def test_empty_table(spark):
    assert queries.round_trip(empty_documents(spark)).collect() == []


def test_every_distinct_word_is_encoded_once(spark):
    df = odd_documents(spark).select("text")
    table = bpe.word_table(df.na.fill(""), PATH).collect()
    assert len({r.word for r in table}) == len(table)
    t = tokens.load(PATH)
    for r in table:
        want = t.encode(r.word, add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want


def test_words_of_a_batch():
    raw = [(t or "").encode() for t in ODD_TEXTS]
    w = bpe.token_words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    names = np.array(w.strings(np.arange(len(w.key))).to_pylist(), object)
    for i, text in enumerate(raw):
        got = "".join(names[w.which[w.offsets[i]:w.offsets[i + 1]]])
        assert got.lower() == b"".join(text.split()).decode().lower()


def test_word_numbers_survive_packing():
    rng = np.random.default_rng(0)
    x = (2.0 ** rng.uniform(0, 31, 5000)).astype(np.int64) - 1
    cuts = np.array([0, 0, 1, 1, 4000, 5000])
    got = [bpe._numbers(p) for p in bpe._packed_numbers(x, cuts)]
    assert all((g == x[a:b]).all() for g, a, b in zip(got, cuts[:-1], cuts[1:]))
    assert [len(g) for g in got] == np.diff(cuts).tolist()
    assert bpe._packed_numbers(np.empty(0, np.int32), np.array([0])) == []


def test_decode_of_null_and_empty_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, 49407])],
                               "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()}
    want = tokens.load(PATH).decode([320, 49407], skip_special_tokens=False)
    assert got == {1: None, 2: "", 3: want}


def test_texts_without_an_id_whose_short_hashes_meet(spark, monkeypatch):
    monkeypatch.setattr(bpe, "HEAD_WORDS", 0)
    texts = spark.range(400_000).select(F.concat(
        F.lit("q"), F.col("id"), F.lit(" zz"), F.col("id") * 7).alias("text"))
    met = texts.groupBy(F.hash("text").alias("h")).agg(
        F.collect_list("text").alias("t")).where("size(t) > 1").limit(3).collect()
    assert met
    both = [(None, t) for r in met for t in r.t]
    df = spark.createDataFrame(both, "doc_id bigint, text string")
    path = tokens.tokenizer_path()
    got = bpe.decode(bpe.encode(df, path), path).collect()
    want = tokens.load(path)
    assert sorted(r.ids for r in got) == sorted(
        want.encode(t, add_special_tokens=False).ids for _, t in both)
