"""Exact nearest neighbours of a stated query set, by a block matrix join.

Queries and candidates are cut into blocks, and every pair of blocks is a
tile: one task row group of bounded size. Within a tile the vectors are
quantised to int8 and multiplied as one matrix product. The quantisation
error of each product is bounded, so a pair whose upper bound is under the
k-th largest lower bound of its query cannot be among the query's k nearest
and is dropped; the pairs that survive are recomputed in double precision on
the original vectors. Each tile keeps k pairs per query in a heap order
(score, then smaller id), and the tiles' lists are merged by a heap.

Data moved: queries x candidate blocks + candidates x query blocks. Both
block counts follow from the tile size, a parameter.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part; rows with a null id take no part. Only
vectors of equal length are compared. Repeated ids are separate candidates,
and separate queries, each with a list of its own; a query never meets a row of
its own id. Equal scores rank by smaller id. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prepare, saved

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
PIECE = 4096  # candidates whose products are held at once
SCHEMA = "query_id bigint, rank int, vec_id bigint, score double"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v array<float or double>, dim) of the rows that take part."""
    v = F.col(vector_column)
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v"), F.size(v).alias("dim")
    ).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite
        & F.exists(F.col("v"), lambda x: x != 0)
    )


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added up component
    by component, so equal vectors always give equal scores."""
    total = np.zeros(len(q))
    for k in range(q.shape[1]):
        total += q[:, k] * c[:, k]
    return total


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the Euclidean norms of what they miss.

    The missing part is measured on the vector itself, so |error| is a true
    bound and not an estimate."""
    scale = np.abs(x).max(axis=1, initial=0.0) / 127.0
    scale[scale == 0] = 1.0
    q8 = np.rint(x / scale[:, None]).astype(np.int8)
    missing = np.linalg.norm(x - q8 * scale[:, None], axis=1)
    return q8, scale, missing


def product_bounds(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of q's and c's rows.

    With x = x' + e: <a, b> = <a', b'> + <a', f> + <e, b>, so the error is at
    most |a'| |f| + |e| |b|. int8 products are whole numbers under 2**24 for
    up to 1040 components, which single precision adds up exactly; longer
    vectors are multiplied in double precision."""
    (a8, sa, ea), (b8, sb, eb) = quantised(q), quantised(c)
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    prod = (a8.astype(kind) @ b8.astype(kind).T).astype(np.float64)
    prod *= sa[:, None]
    prod *= sb[None, :]
    na = np.linalg.norm(a8 * sa[:, None], axis=1)
    nb = np.linalg.norm(c, axis=1)
    error = na[:, None] * eb[None, :] + ea[:, None] * nb[None, :]
    error = error * (1 + 1e-9) + 1e-12 * (1 + np.abs(prod))  # rounding of the bounds themselves
    return prod - error, prod + error


def tile_top(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query positions, candidate ids, scores) of each query's k best in a tile."""
    out: list[tuple[np.ndarray, ...]] = []
    floor = np.full(len(q_ids), -np.inf)  # k-th best score so far: nothing under it can enter
    best: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    for lo in range(0, len(c_ids), PIECE):
        ids, part = c_ids[lo:lo + PIECE], c[lo:lo + PIECE]
        low, high = product_bounds(q, part)
        own = q_ids[:, None] == ids[None, :]
        low[own], high[own] = -np.inf, -np.inf
        if len(ids) > k:
            kth = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
            floor = np.maximum(floor, kth)
        qi, ci = np.nonzero((high >= floor[:, None]) & ~own)
        score = np.concatenate(
            [exact_scores(q[qi[i:i + 65536]], part[ci[i:i + 65536]])
             for i in range(0, len(qi), 65536)] or [np.empty(0)]
        )
        order = np.lexsort((ids[ci], -score, qi))
        qi, ci, score = qi[order], ci[order], score[order]
        first = np.searchsorted(qi, np.arange(len(q_ids)))
        keep = np.arange(len(qi)) - first[qi] < k
        for i, j, s in zip(qi[keep], ids[ci[keep]], score[keep]):
            item = (float(s), -int(j))
            if len(best[i]) < k:
                heapq.heappush(best[i], item)
            elif item > best[i][0]:
                heapq.heapreplace(best[i], item)
        for i, heap in enumerate(best):
            if len(heap) == k:
                floor[i] = max(floor[i], heap[0][0])
    for i, heap in enumerate(best):
        if heap:
            s, j = zip(*heap)
            out.append((np.full(len(s), i), -np.array(j, np.int64), np.array(s)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(
    queries: DataFrame, candidates: DataFrame, k: int = 20,
    id_column: str = "vec_id", vector_column: str = "embedding",
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k candidates of largest
    inner product, all of them if there are fewer."""
    prepare(queries.sparkSession)
    q, c = (usable(x, id_column, vector_column) for x in (queries, candidates))
    # numbered and written, so that a query row keeps its number
    q = saved(q.select("*", F.monotonically_increasing_id().alias("query")), "queries")
    c = c.select("*", F.lit(None).cast("bigint").alias("query"))
    # Two counts decide the grid; every row is then dealt by a hash of its id.
    n_q, n_c = (x.select("vec_id").count() for x in (q, c))
    q_blocks, c_blocks = max(1, -(-n_q // query_block)), max(1, -(-n_c // candidate_block))

    def dealt(df, side, own, n_own, other, n_other):
        block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_own)).cast("int")
        all_of = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.select(
            "vec_id", "query", F.col("v").cast("array<double>").alias("v"), "dim",
            F.lit(side).alias("side"), block.alias(own), all_of.alias(other),
        )

    sides = dealt(q, 0, "qb", q_blocks, "cb", c_blocks).unionByName(
        dealt(c, 1, "cb", c_blocks, "qb", q_blocks)
    )

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows.side == 0], rows[rows.side == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        ids = a.vec_id.to_numpy()
        at, others, score = tile_top(
            ids, np.stack(a.v.to_numpy()), b.vec_id.to_numpy(), np.stack(b.v.to_numpy()), k,
        )
        return pd.DataFrame({
            "query": a["query"].to_numpy()[at].astype(np.int64), "query_id": ids[at],
            "vec_id": others, "score": score})

    found = sides.groupBy("qb", "cb", "dim").applyInPandas(
        tile, "query bigint, query_id bigint, vec_id bigint, score double"
    )

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heap: list[tuple[float, int]] = []
        now = None

        def flush():
            ranked = sorted(heap, reverse=True)
            return pd.DataFrame({
                "query_id": np.full(len(ranked), now[1]),
                "rank": np.arange(1, len(ranked) + 1, dtype=np.int32),
                "vec_id": [-j for _, j in ranked], "score": [s for s, _ in ranked],
            })

        for frame in frames:
            for row, i, j, s in zip(frame["query"], frame.query_id, frame.vec_id, frame.score):
                if (row, i) != now:
                    if heap:
                        yield flush()
                    heap, now = [], (row, i)
                if len(heap) < k:
                    heapq.heappush(heap, (s, -j))
                else:
                    heapq.heappushpop(heap, (s, -j))
        if heap:
            yield flush()

    dealt_again = found.repartition("query").sortWithinPartitions("query")
    return dealt_again.mapInPandas(merged, SCHEMA)
