from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import fingerprints as fp
from quarry.llm import queries
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


def brute(rows):
    """(id, n_chars, sha) and true likenesses, rows in order."""
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(t, e),
                    jaccard(t, nxt)))
    return out


def test_query(spark):
    rows = sorted((d["doc_id"], d["text"]) for d in documents())
    want = brute(rows)
    got = sorted(queries.op7_fingerprints(spark, SF).collect())
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in want]
    err = np.array([(r.near_edited - w[3], r.near_next - w[4]) for r, w in zip(got, want)])
    assert np.abs(err).max() < 0.2 and np.abs(err).mean() < 0.03
    assert abs(err[:, 0].mean()) < 0.01  # no bias left
    by_text = {}
    for (_, t), r in zip(rows, got):
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 2 * (1 + fp.BINS * fp.BITS // 8)


@pytest.mark.parametrize("n", [1, 3, 50])
def test_small_tables_and_wrap(spark, n):
    docs = [(i * 7, f"text number {i} " * (i + 1)) for i in range(n)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted(fp.edited_fingerprints(df).collect())
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in brute(docs)]


def test_odd_texts(spark):
    df = odd_documents(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256)
                  for r in fp.edited_fingerprints(df).collect()), key=str)
    assert got == sorted((w[:3] for w in brute(rows)), key=str)


def test_empty_table(spark):
    assert fp.edited_fingerprints(empty_documents(spark)).collect() == []


def test_likeness_of_special_cases():
    bits, some = fp._of(["", "  ", "one", "one", "two", "a b c d e f", "A B C D E F"])
    like = lambda i, j: fp.likeness(bits[[i]], some[[i]], bits[[j]], some[[j]])[0]
    assert like(0, 1) == 1.0 and like(0, 2) == 0.0
    assert like(2, 3) == 1.0 and like(2, 4) < 0.5 and like(5, 6) == 1.0
    back, has = fp.unpacked(fp.packed(bits, some))
    assert (back == bits).all() and (has == some).all()


def test_batches_do_not_matter(monkeypatch):
    texts = [t or "" for t in ODD_TEXTS]
    whole = fp.packed(*fp._of(texts))
    monkeypatch.setattr(fp, "BYTES", 100)
    assert fp.packed(*fp._of(texts)) == whole


def test_general_interface(spark):
    df = odd_documents(spark).withColumn("fingerprint", F.lit("old"))
    got = {r.text: r.fingerprint for r in fp.fingerprints(df).collect()}
    assert got["a b c d e f g h i j"] == fp.packed(*fp._of(["a b c d e f g h i j"]))[0].hex()
