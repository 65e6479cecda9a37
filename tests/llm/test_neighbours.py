from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import neighbours, queries
from tests.llm.helpers import SF, documents

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def dot(v, w):
    total = 0.0  # plain addition; sum() compensates
    for a, b in zip(v, w):
        total += float(np.float32(a)) * float(np.float32(b))
    return total


def brute(q, c, k):
    out = []
    for i, v in q:
        s = sorted(
            ((-dot(v, w), j)
             for j, w in c if j != i and len(w) == len(v))
        )[:k]
        out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(d["vec_id"], d["embedding"]) for d in documents("embeddings")]
    want = brute([r for r in rows if r[0] % 20 == 0], rows, 20)
    assert found(queries.op4_nearest_neighbours(spark, SF)) == want


ODD = [
    (0, [1.0, 0.0], 1), (20, [0.5, -0.5], 1), (40, None, 1), (60, [0.0, 0.0], 1),
    (80, [float("nan"), 1.0], 1), (100, [float("inf"), 1.0], 1), (120, [None, 1.0], 1),
    (140, [], 1), (160, [1.0, 2.0, 3.0], 1), (180, [3.0, 1.0, 3.0], 1), (None, [1.0, 1.0], 1),
    (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1e30, 1e-30], None),
    (4, [-1e-20, 1e-20], 0), (5, [-1.0, -1.0], 0),
]


def test_odd_vectors_and_ties(spark):
    df = spark.createDataFrame(ODD, SCHEMA).withColumn("score", F.lit("x"))
    rows = [(i, v) for i, v, _ in ODD if i is not None and fine(v)]
    want = brute([r for r in rows if r[0] % 20 == 0], rows, 3)
    for qb, cb in ((1024, 8192), (1, 2)):
        got = neighbours.nearest(df.where("vec_id % 20 = 0"), df, 3, query_block=qb,
                                 candidate_block=cb)
        assert found(got) == want


def test_repeated_query_rows_get_lists_of_their_own(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [-1.0, 2.0], 1), (0, [1.0, 0.5], 1), (20, [0.5, 0.5], 1),
            *((i, [float(i % 5), float(i % 3) - 1], 0) for i in range(1, 12))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([r[:2] for r in rows if r[0] % 20 == 0],
                 [r[:2] for r in rows if fine(r[1])], 4)
    for qb, cb in ((1024, 8192), (1, 3)):
        got = neighbours.nearest(df.where("vec_id % 20 = 0"), df, 4, query_block=qb,
                                 candidate_block=cb)
        assert found(got) == want and len(want) == 16


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(df, df).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(20, 64)), rng.normal(size=(300, 64)) * rng.lognormal(size=(300, 1))
    low, high = neighbours.product_bounds(q, c)
    true = q @ c.T
    assert (low <= true).all() and (true <= high).all()
    norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)
    assert np.median((high - low) / norms) < 0.05


def test_hot_vector(spark):
    rows = [(i, [1.0, 0.5, 0.25] if i % 3 else [float(i), 1.0, -2.0], 0) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.nearest(df.where("vec_id % 20 = 0"), df, 20, query_block=16,
                             candidate_block=50)
    want = brute([r[:2] for r in rows if r[0] % 20 == 0], [r[:2] for r in rows], 20)
    assert found(got) == want
