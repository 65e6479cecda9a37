from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import queries, simhash
from quarry.llm.common import LOWER
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def brute(fps, radius=2):
    """Component (smallest id) of every (id, fingerprint)."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(fps)),
                  key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    want = brute([(d["doc_id"], brute_print(d["text"])) for d in documents()])
    assert got(queries.op11_simhash_dedup(spark, SF)) == want
    assert len({w[2] for w in want}) < len(want)


def test_odd_documents(spark):
    df = odd_documents(spark).withColumn("fp", F.lit("clash")).withColumn("n", F.lit(1))
    rows = [(r.doc_id, brute_print(r.text)) for r in df.collect()]
    assert got(simhash.near_duplicates(df)) == brute(rows)


def test_empty(spark):
    assert got(simhash.near_duplicates(empty_documents(spark))) == []


def test_rows_without_id_and_repeated_ids(spark):
    schema = "doc_id bigint, text string"
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "x y z"), (9, "x y z"), (4, "x y z"),
            (4, "p q r"), (4, "p q r"), (None, None), (2, ""), (7, "   ")]
    want = brute([(d, brute_print(t)) for d, t in rows])
    assert got(simhash.near_duplicates(spark.createDataFrame(rows, schema))) == want


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["ab", "Cd", "é", "fgh", "日本"]) for _ in range(500)).encode()
    whole = simhash.fingerprint(text)
    assert whole % 2**64 == brute_print(text.decode())
    for size in (1, 7, 64):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text) == whole
        for t in ODD_TEXTS:
            assert simhash.fingerprint((t or "").encode()) % 2**64 == brute_print(t)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_within_the_radius_meets(radius):
    tables = simhash.covering(list(range(64)), radius)
    assert len(tables) == 2 ** (radius + 1) - 1
    rng = np.random.default_rng(radius)
    cases = itertools.combinations(range(64), radius) if radius < 3 else (
        rng.choice(64, radius, replace=False) for _ in range(3000))
    for differing in cases:
        assert any(not set(kept) & set(differing) for kept in tables)


def test_free_bits_shrink_below_any_bucket():
    masks = [0]
    for free in (28, 12, 6):
        masks = simhash.refined(masks, 2)
        assert max(64 - m.bit_count() for m in masks) <= free


@pytest.mark.parametrize("bucket", [512, 16])
def test_hot_buckets_are_cut_and_lose_no_link(spark, bucket):
    # thousands of fingerprints that share most bits, in clusters and alone
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {0, base}
    for _ in range(700):
        fps.add(base ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 6))))
    for _ in range(200):
        fps.add(rng.getrandbits(64))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(nodes, 2, bucket).collect()]
    assert all(1 <= (a ^ b).bit_count() <= 2 for a, b in edges)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in edges:
        root[find(a)] = find(b)
    want = {f: c for f, _, c in brute(list(enumerate(fps)))}
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(find(f), set()).add(i)
    assert {min(g): g for g in groups.values()} == {
        c: {i for i in want if want[i] == c} for c in set(want.values())}


def test_copies_do_not_fill_buckets(spark):
    rows = [(i, "the same text of several words") for i in range(3000)] + [(5000, "other words here")]
    found = got(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                        bucket=8))
    assert {c for d, _, c in found if d < 5000} == {0}
    assert len(found) == 3001
