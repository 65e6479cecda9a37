"""Hard-negative mining by the Fagin threshold algorithm.

Vectors become whole numbers, floor(SCALE * x) in each component, and a row's
score for an anchor is their inner product. An anchor's positives are its best
rows of the same label; of each positive with score s, the hard negatives are
the best rows of other labels with low * s <= 100 * score <= high * s.

Anchors and rows are cut into blocks, and every pair of blocks is a tile of
bounded size (the anchors are a stated query set). A tile sorts the components
of its rows once, a list for each dimension, and runs the threshold algorithm
for each anchor:

* sorted access goes down all lists at once, from the large end where the
  anchor's component is positive and from the small end where it is negative;
* a row met for the first time is scored in whole numbers (random access);
* the threshold is the score of a row that had, in every list, the value last
  seen there: no row that is still unseen can score more;
* an anchor is done once, for each of its windows, the threshold is strictly
  below the window's k-th score so far, or below the window itself. Equal
  scores rank by smaller id, hence strictly.

The tiles' lists, k rows a window at most, are merged by rank. Positives and
negatives take a pass each: windows follow from the positives of all tiles.
Positives are looked for in lists of the anchor's label only.

Scores are exact. Where a tile's products could pass 63 bits they are computed
in Python's integers; a returned score that does not fit 63 bits fails the
job, and so does a component over 2^53 after scaling, which has no exact double.

Defined results: rows with a null id, a null label, a null vector or any null
or non-finite component take no part; zero and empty vectors do. Only vectors
of equal length are compared. Rows of one id are separate rows: each is an
anchor of its own, and a candidate for the other. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import prepare, saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # a window, in hundredths of the positive's score
ANCHOR_BLOCK = 256
ROW_BLOCK = 8192
STEP = 16  # rows of each list that are read before the threshold is looked at, at first


def usable(vectors: DataFrame, label: Column, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """(row, vec_id, label, v array<bigint>, dim) of the rows that take part;
    ``row`` tells rows apart. Written, so that it stays as it is."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    big = F.lit("a component is too large for exact products")
    scaled = F.transform(v, lambda x: F.when(
        F.abs(x) * SCALE < 2.0**53, F.floor(x * SCALE)).otherwise(F.raise_error(big).cast("bigint")))
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.when(finite, scaled).alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return saved(rows.select(F.monotonically_increasing_id().alias("row"), "*",
                             F.size("v").alias("dim")), "negatives-rows")


class Lists:
    """The sorted lists of a set of rows, in order of (row vectors, ids)."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.v, self.ids, self.rows, self.labels = v, ids, rows, labels
        self.order = np.argsort(v, axis=0, kind="stable")
        self.values = np.take_along_axis(v, self.order, axis=0)

    def search(self, anchor: np.ndarray, taken, windows: list[tuple], k: int):
        """For each window (least, most; None: open) the k best rows that
        ``taken`` (a mask over rows) allows, as positions and scores."""
        n = len(self.v)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        seen = np.zeros(n, bool)
        score = np.zeros(n, self.v.dtype)
        best = [np.empty(0, np.int64)] * len(windows)
        open_windows = [i for i, (least, most) in enumerate(windows)
                        if least is None or least <= most]
        at, step = 0, STEP
        while open_windows and at < n:
            to = min(at + step, n)
            if len(up) + len(down):
                met = np.unique(np.concatenate(
                    [self.order[at:to, up].ravel(), self.order[n - to:n - at, down].ravel()]))
                met = met[~seen[met]]
                bound = int((self.values[to - 1, up] * anchor[up]).sum()
                            + (self.values[n - to, down] * anchor[down]).sum())
            else:  # every score is 0
                to, met, bound = n, np.arange(n), 0
            seen[met] = True
            met = met[taken[met]]
            score[met] = self.v[met] @ anchor
            for i in list(open_windows):
                least, most = windows[i]
                new = met if least is None else met[(score[met] >= least) & (score[met] <= most)]
                both = np.concatenate([best[i], new])
                order = np.lexsort((self.ids[both], -score[both]))[:k]
                best[i] = both[order]
                if (least is not None and bound < least) or (
                        len(best[i]) == k and bound < score[best[i][-1]]):
                    open_windows.remove(i)
            at, step = to, 2 * step
        return [(b, score[b]) for b in best]


def _exact(anchors: np.ndarray, rows: np.ndarray):
    """Both as 64-bit numbers if no product can overflow, else as Python's."""
    if anchors.size and rows.size:
        most = int(np.abs(anchors).max()) * int(np.abs(rows).max()) * anchors.shape[1]
        if most >= 2**62:
            return anchors.astype(object), rows.astype(object)
    return anchors, rows


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _vectors(table: pa.Table) -> np.ndarray:
    dim = table.column("dim")[0].as_py()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(table), dim).astype(np.int64)


def _tiles(anchors: DataFrame, rows: DataFrame, anchor_block: int, row_block: int) -> DataFrame:
    """Anchors and rows, each dealt to its block by a hash of the row, once for
    every block of the other. Two counts decide the grid."""
    n_a = max(1, -(-anchors.count() // anchor_block))
    n_r = max(1, -(-rows.count() // row_block))

    def dealt(df: DataFrame, side: int, own: str, n_own: int, other: str, n_other: int):
        block = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")
        return df.withColumns({
            "side": F.lit(side), own: block,
            other: F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))})

    return dealt(anchors, 0, "ab", n_a, "rb", n_r).unionByName(
        dealt(rows, 1, "rb", n_r, "ab", n_a), allowMissingColumns=True)


def _found(tiles: DataFrame, one_tile, schema: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        a, r = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
        out = one_tile(a, r) if len(a) and len(r) else []
        names = [c.split()[0] for c in schema.split(", ")]
        columns = [np.concatenate(c) for c in zip(*out)] if out else [()] * len(names)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return tiles.groupBy("ab", "rb", "dim").applyInArrow(run, schema)


def positives(anchors: DataFrame, rows: DataFrame, k: int = POSITIVES,
              anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(row, anchor_id, no, positive_id, positive_score): the k best other rows
    of each anchor's label."""
    def one_tile(a: pa.Table, r: pa.Table):
        av, rv = _exact(_vectors(a), _vectors(r))
        own, ids, labels = (_column(r, c) for c in ("row", "vec_id", "label"))
        lists = {}
        for anchor, row, vec_id, label in zip(
                av, *(_column(a, c) for c in ("row", "vec_id", "label"))):
            if label not in lists:
                of = np.flatnonzero(labels == label)
                lists[label] = Lists(rv[of], ids[of], own[of], labels[of])
            among = lists[label]
            [(at, score)] = among.search(anchor, among.rows != row, [(None, None)], k)
            yield (np.full(len(at), row), np.full(len(at), vec_id), among.ids[at], score)

    found = _found(
        _tiles(anchors, rows, anchor_block, row_block), one_tile,
        "row bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("no", F.row_number().over(order)).where(F.col("no") <= k)


def mine(anchors: DataFrame, rows: DataFrame, n_positives: int = POSITIVES,
         n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``anchors``: some of the ``rows``, both of :func:`usable`."""
    prepare(rows.sparkSession)
    best = saved(positives(anchors, rows, n_positives, anchor_block, row_block), "positives")
    # bounded lists: n_positives entries an anchor
    windows = best.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("no", "positive_id", "positive_score"))).alias("windows"))
    asking = anchors.join(windows, "row")

    def one_tile(a: pa.Table, r: pa.Table):
        av, rv = _exact(_vectors(a), _vectors(r))
        labels = _column(r, "label")
        lists = Lists(rv, _column(r, "vec_id"), _column(r, "row"), labels)
        rest = zip(av, _column(a, "row"), _column(a, "vec_id"), _column(a, "label"),
                   a.column("windows").to_pylist())
        for anchor, row, vec_id, label, given in rest:
            asked = [x["positive_score"] for x in given]
            # whole scores s with low * p <= 100 * s <= high * p
            bounds = [(-(-low * p // 100), high * p // 100) for p in asked]
            for x, (at, score) in zip(given, lists.search(
                    anchor, labels != label, bounds, n_negatives)):
                yield (*(np.full(len(at), y) for y in (
                    row, x["no"], vec_id, x["positive_id"], x["positive_score"])),
                    lists.ids[at], score)

    found = _found(
        _tiles(asking, rows, anchor_block, row_block), one_tile,
        "row bigint, no bigint, anchor_id bigint, positive_id bigint, positive_score bigint, "
        "negative_id bigint, negative_score bigint")
    order = Window.partitionBy("row", "no").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                         "negative_score")
