from __future__ import annotations

import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import jaccard, queries
from quarry.llm.components import connected
from tests.llm.helpers import SF, documents, empty_documents, odd_documents


def shingle_set(text, k=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=85):
    """Counter of (id, size, component, links)."""
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    near = defaultdict(set)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x] if j != i)
        near[i] = {j for j, n in both.items()
                   if 100 * n >= percent * (len(s) + len(sets[j]) - n)}
    out, seen = Counter(), {}
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        seen.update(dict.fromkeys(group, least))
    for i, (d, _) in enumerate(rows):
        out[d, len(sets[i]), seen[i], len(near[i])] += 1
    return out


def result(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect())


@pytest.mark.parametrize("block", [512, 8])
def test_query_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = result(queries.op3_ngram_jaccard_join(spark, SF))
    want = brute([(d["doc_id"], d["text"]) for d in documents()])
    assert got == want
    assert any(n > 0 for _, _, _, n in want)


def family(rng, n, words, most_edits, base=None):
    """Copies of one text with up to ``most_edits`` changed words each."""
    base = base or [f"w{x}" for x in rng.integers(0, 10_000, words)]
    out = []
    for _ in range(n):
        t = list(base)
        for at in rng.integers(0, len(t), rng.integers(0, most_edits + 1)):
            t[at] = f"e{rng.integers(0, 10 ** 6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("block", [512, 16])
def test_near_copies_around_the_limit(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{x}" for x in range(50))
    texts = family(rng, 60, 150, 8) + family(rng, 30, 40, 2) + family(rng, 20, 600, 25)
    texts += [f"{passage} " + " ".join(f"u{x}" for x in rng.integers(0, 10 ** 6, n))
              for n in rng.integers(0, 120, 60)]
    texts += family(rng, 20, 9, 1) + family(rng, 10, 5, 1) + ["short one"] * 3
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(jaccard.join(df)) == brute(rows)


def test_odd_texts(spark):
    df = odd_documents(spark).withColumn("node", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(jaccard.join(df)) == brute(rows)


LONG = [" ".join(f"{t}{x}" for x in range(60)) for t in "abc"]


@pytest.mark.parametrize("rows", [
    [(5, LONG[0]), (5, LONG[0]), (9, LONG[0] + " more")],
    [(5, LONG[0]), (5, LONG[1]), (3, LONG[0] + " x"), (9, LONG[1] + " y"), (8, LONG[1] + " z")],
])
def test_rows_of_one_id(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert result(jaccard.join(df)) == brute(rows)


def test_near_copies_without_an_id(spark):
    base = LONG[0].split()
    chain = [" ".join(base[i:] + [f"z{x}" for x in range(i)]) for i in (0, 3, 6)]  # links 0-3-6
    rows = [(7, chain[0]), (None, chain[1]), (None, chain[1]), (2, chain[2]),
            (None, LONG[1]), (None, LONG[1] + " more"), (4, LONG[2]), (None, LONG[2] + " more")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows)
    assert {c for d, _, c, _ in want if d == 7} == {2}
    assert result(jaccard.join(df)) == want


def test_empty_table(spark):
    assert jaccard.join(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_signature(seed):
    rng = np.random.default_rng(seed)
    bands, met = jaccard.Bands(85), 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        keep = a[rng.random(len(a)) > rng.uniform(0, 0.12)]
        extra = rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 12))).astype(np.uint64)
        b = np.unique(np.concatenate([keep, extra]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        met += 1
        flat, ends = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        sig, row = jaccard.signatures(flat, ends, bands)
        assert len(np.intersect1d(sig[row == 0], sig[row == 1]))
        for p in {int(x) for x in bands.of(np.array([len(a), len(b)]))}:
            h = bands.pair(p)[0]
            if len(np.setxor1d(a, b)) <= h:  # one-deletion neighbourhoods at any size
                assert len(np.intersect1d(*(jaccard.deletion_signatures(x, p, h) for x in (a, b))))
    assert met > 30


@pytest.mark.parametrize("seed", range(3))
def test_sketches_never_overstate_a_difference(seed):
    rng = np.random.default_rng(seed)
    for _ in range(100):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([
            a[rng.random(len(a)) > rng.uniform(0, 0.9)],
            rng.integers(0, 1 << 63, int(rng.integers(0, 300))).astype(np.uint64)]))
        one, two = (np.frombuffer(x, np.uint64)[None] for x in jaccard.sketches(
            np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        words = min(one.shape[1], two.shape[1])
        d = int(np.bitwise_count(jaccard.folded(one, words) ^ jaccard.folded(two, words)).sum())
        assert d <= len(np.setxor1d(a, b))


def test_reach_connects_what_may_link():
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 1 << 63, 120).astype(np.uint64) for _ in range(4)]
    sets = []
    for _ in range(60):
        x = base[rng.integers(0, 4)].copy()
        x[rng.integers(0, 120, rng.integers(0, 12))] = rng.integers(0, 1 << 63, 1)
        sets.append(np.unique(x))
    ends = np.cumsum([0, *map(len, sets)])
    bits = np.stack([np.frombuffer(x, np.uint64) for x in
                     jaccard.sketches(np.concatenate(sets), ends)])
    sizes = np.diff(ends)
    d = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2)
    ok = jaccard.may_link(d, sizes[:, None], sizes[None], 85)

    def groups(pairs):
        parent = list(range(60))
        for i, j in pairs:
            a, b = parent[i], parent[j]
            parent = [a if x == b else x for x in parent]
        return [parent.index(x) for x in parent]

    assert groups(jaccard.reach(bits, sizes, 85)) == groups(np.argwhere(ok))


@pytest.mark.parametrize("most", [1, 3, 1000])
@pytest.mark.parametrize("size", [1, 4, 1000])
def test_every_signature_is_covered_by_buckets(monkeypatch, most, size):
    # called in this process: workers import the module on their own
    monkeypatch.setattr(jaccard, "BUCKET", most)
    rng = np.random.default_rng(6)
    rows = np.unique(rng.integers(0, 40, (300, 2)), axis=0)
    rows = np.concatenate([rows, rows[::7], [[7, x] for x in range(100, 160)]])
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    batches = (pa.RecordBatch.from_arrays(
        [pa.array(rows[i:i + size, 0]), pa.array(rows[i:i + size, 1])], names=["sig", "node"])
        for i in range(0, len(rows), size))
    in_bucket = defaultdict(set)
    for out in jaccard._buckets(batches):
        for key, node, sure in zip(*(c.to_pylist() for c in out.columns)):
            in_bucket[key, sure].add(node)
    assert all(len(nodes) > 1 for nodes in in_bucket.values())
    for sig in set(rows[:, 0].tolist()):
        nodes = sorted(set(rows[rows[:, 0] == sig, 1].tolist()))
        together = any(set(nodes) <= b for (_, sure), b in in_bucket.items() if not sure)
        with_first = all(any({nodes[0], x} == b for (_, sure), b in in_bucket.items() if sure)
                         for x in nodes[1:])
        assert len(nodes) == 1 or together or with_first


def test_edges_do_not_depend_on_batches():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 300, int(rng.integers(100, 260))).astype(np.uint64))
            for _ in range(60)]
    bits = jaccard.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    bucket = np.sort(rng.integers(0, 18, 60))
    cols = [bucket, np.arange(60), np.zeros(60, bool), np.array([len(x) for x in sets])]

    def run(size):
        batches = (pa.RecordBatch.from_arrays(
            [*(pa.array(c[i:i + size]) for c in cols), pa.array(bits[i:i + size], pa.binary())],
            names=["bucket", "node", "sure", "n", "bits"]) for i in range(0, 60, size))
        return {(a, b) for out in jaccard._edges(30)(batches)
                for a, b in zip(*(c.to_pylist() for c in out.columns))}

    assert run(60) == run(7) == run(1) and run(60)


def test_links_of_a_tile():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(40)]
    want = {(i, j) for i in range(40) for j in range(i + 1, 40)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))}
    assert set(map(tuple, jaccard.links(sets, 40).tolist())) == want
    across = set(map(tuple, jaccard.links(sets, 40, 10).tolist()))
    assert across == {(i, j) for i, j in want if i < 10 <= j}
    assert set(map(tuple, jaccard.links(sets[:3], 40).tolist())) == {
        (i, j) for i, j in want if j < 3}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 2000 + i) for i in range(50)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in connected(df).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}


def test_memory_of_a_slice_and_of_a_tile():
    # a Python worker stands beside a full heap: a slice of texts and a tile
    # take a few dozen MB at most
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 20_000, jaccard.SLICE_BYTES // 6)]
    raw = [" ".join(words[i:i + 350]).encode() for i in range(0, len(words), 350)]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    sets = [np.sort(rng.choice(200_000, 400, replace=False)).astype(np.uint64)
            for _ in range(jaccard.BLOCK)]
    tracemalloc.start()
    try:
        jaccard.signatures(*jaccard.element_sets(data, ends, 5), jaccard.Bands(80))
        slice_peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        jaccard.links(sets, 80)
        tile_peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert slice_peak < 60e6 and tile_peak < 60e6
