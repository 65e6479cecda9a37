"""Best-fit packing of token pieces into sequences by a grouping genetic
algorithm.

Pieces are dealt by a hash into blocks of about BLOCK pieces. Only the sorted
lengths of a block matter, so its search state is small. Every block is
searched by ISLANDS independent populations, spread over the cluster: an
individual is a grouping of pieces into bins, and crossover injects whole
well-filled bins of one parent into the other, removes the bins that hold a
duplicate and puts the displaced pieces back by best fit. After every epoch
each island's best individual migrates to the next island of its block. A
block whose best individual reaches the lower bound ceil(sum / capacity)
is done. Poorly filled bins of all blocks are then opened and their pieces
packed again together, so that the loss at block edges does not add up.

Every piece is placed; nothing is dropped. State goes through tables in the
shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import tokens
from quarry.llm.common import saved, sliced, prepare, text_buffers

CAPACITY = 2048
BLOCK = 4096
ISLANDS = 3
POPULATION = 4
EPOCHS = 2
GENERATIONS = 8
TASKS = 8  # of a search, times the shuffle partitions
WELL_FILLED = 0.98  # of the capacity: bins worth injecting
REOPEN = 0.95  # bins under this fill are packed again with other blocks' bins


def token_pieces(
    docs: DataFrame, path: str, length: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids, slot): the ids of each text without
    special tokens, then ``end_id``, cut into pieces of ``length`` only where
    longer. ``ids`` are packed little-endian unsigned 32-bit integers; ``slot``
    numbers the pieces of a task, to tell repeated rows apart. Null text is
    empty: one piece holding ``end_id``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = 0
        for batch in batches:
            for part in sliced(batch, "text"):
                data, off = text_buffers(part.column(1))
                ids, n = tokens.encode_texts(path, data, off)
                size = n + 1  # with the end id
                first = np.cumsum(size) - size
                flat = np.full(int(size.sum()), end_id, "<u4")
                inside = np.ones(len(flat), bool)
                inside[first + n] = False
                flat[inside] = ids
                pieces = -(-size // length)
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * length
                long = np.minimum(size[row] - start, length)
                at = (first[row] + start) * 4
                raw = flat.tobytes()
                for lo in range(0, len(row), 4096):  # small batches: the ids are the bulk
                    s = slice(lo, lo + 4096)
                    k = len(row[s])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row[s])), pa.array(piece[s], pa.int32()),
                         pa.array(start[s], pa.int64()), pa.array(long[s], pa.int64()),
                         pa.array([raw[a:a + 4 * m] for a, m in zip(at[s], long[s])], pa.binary()),
                         pa.array(np.arange(slot, slot + k), pa.int64())],
                        names=["doc_id", "piece", "start", "length", "ids", "slot"],
                    )
                    slot += k

    few = docs.select(F.col("doc_id").cast("bigint"), "text")
    return few.mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids binary, slot bigint"
    )


# --- one block: individuals are arrays of bin numbers, pieces by falling length ---


def best_fit(
    sizes: np.ndarray, pieces: np.ndarray, bins: np.ndarray, room: list[int], capacity: int
) -> None:
    """Put ``pieces`` (in order) each into the fullest bin with room, opening
    bins as needed. ``room``: free space per bin; both are changed in place."""
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r free
    for b, r in enumerate(room):
        if r > 0:
            with_room[r].append(b)
            mask |= 1 << r
    for i, n in zip(pieces.tolist(), sizes[pieces].tolist()):
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = with_room[r].pop()
            if not with_room[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        room[b] = r = r - n
        if r:
            with_room[r].append(b)
            mask |= 1 << r


def packed(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins = np.full(len(sizes), -1, np.int32)
    best_fit(sizes, order, bins, [], capacity)
    return bins


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more uneven fill."""
    fill = np.bincount(bins, sizes)
    return -len(fill), float(((fill / capacity) ** 2).mean())


def crossover(
    sizes: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng: np.random.Generator
) -> np.ndarray:
    """A child of ``a`` with well-filled bins of ``b`` injected whole."""
    fill_b = np.bincount(b, sizes)
    good = np.flatnonzero(fill_b >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(-fill_b)[:max(1, len(fill_b) // 4)]
    chosen = np.zeros(len(fill_b), bool)
    chosen[rng.choice(good, max(1, len(good) // 3), replace=False)] = True
    injected = chosen[b]
    broken = np.zeros(int(a.max()) + 1, bool)
    broken[a[injected]] = True  # bins of a that hold a duplicate
    lone = np.flatnonzero(~broken)
    if len(lone):  # mutation: the emptiest and a few other bins open as well
        fill_a = np.bincount(a, sizes, len(broken))
        broken[lone[np.argmin(fill_a[lone])]] = True
        broken[rng.choice(lone, min(2, len(lone)))] = True
    kept = ~injected & ~broken[a]
    child = np.full(len(sizes), -1, np.int32)
    _, child[injected] = np.unique(b[injected], return_inverse=True)
    n = int(child.max()) + 1
    if kept.any():
        _, again = np.unique(a[kept], return_inverse=True)
        child[kept] = again + n
    placed = child >= 0
    room = (capacity - np.bincount(child[placed], sizes[placed])).astype(int).tolist()
    best_fit(sizes, np.flatnonzero(~placed), child, room, capacity)
    return child


def evolve(
    sizes: np.ndarray, people: list[np.ndarray], capacity: int, generations: int,
    rng: np.random.Generator,
) -> list[np.ndarray]:
    """The population after some generations, best first. Stops at the lower
    bound of the number of bins."""
    bound = -(-int(sizes.sum()) // capacity)
    people = list(people)
    if not people:
        people = [packed(sizes, np.arange(len(sizes)), capacity)]
    while len(people) < POPULATION and people[0].max() + 1 > bound:
        noise = sizes * rng.uniform(0.8, 1.2, len(sizes))
        people.append(packed(sizes, np.argsort(-noise, kind="stable"), capacity))

    def rank(x):
        return fitness(sizes, x, capacity)

    people.sort(key=rank, reverse=True)
    for _ in range(generations):
        if people[0].max() + 1 <= bound:
            break
        i, j = rng.choice(len(people), 2, replace=False) if len(people) > 1 else (0, 0)
        people += [crossover(sizes, people[i], people[j], capacity, rng),
                   crossover(sizes, people[j], people[i], capacity, rng)]
        people.sort(key=rank, reverse=True)
        people = people[:POPULATION]
    return people


# --- Spark: blocks x islands ---

_STATE = "block bigint, island int, sizes binary, people array<binary>, bins int, bound int"


def _tasks(spark: SparkSession, n_blocks: int) -> int:
    """One for four islands, but at most TASKS times the shuffle partitions:
    the number of tasks follows the cluster, not the rows."""
    most = TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-n_blocks * ISLANDS // 4), most))


def _search(blocks: DataFrame, n_blocks: int, capacity: int) -> DataFrame:
    """(block, bins binary): the best grouping found for each block's lengths,
    longest first."""

    def evolved(epoch: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for r in frame.itertuples(index=False):
                    sizes = np.frombuffer(r.sizes, np.int32)
                    people = [np.frombuffer(p, np.int32) for p in r.people]
                    rng = np.random.default_rng([epoch, r.island, abs(int(r.block))])
                    people = evolve(sizes, people, capacity, GENERATIONS, rng)
                    bound = -(-int(sizes.sum()) // capacity)
                    out.append((r.block, r.island, r.sizes, [p.tobytes() for p in people],
                                int(people[0].max()) + 1, bound))
                yield pd.DataFrame(out, columns=["block", "island", "sizes", "people", "bins",
                                                 "bound"])
        return run

    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    state = blocks.select(
        "block", islands, "sizes", F.array().cast("array<binary>").alias("people"),
        F.lit(0).alias("bins"), F.lit(0).alias("bound"),
    )
    for epoch in range(EPOCHS):
        # islands of a block go to different tasks; the state is one small row each
        dealt = state.repartition(_tasks(blocks.sparkSession, n_blocks), "block", "island")
        state = saved(dealt.mapInPandas(evolved(epoch), _STATE), "packing-state")
        if epoch + 1 < EPOCHS:
            guest = state.select(
                "block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                F.col("people")[0].alias("guest"), F.col("bins").alias("guest_bins"),
            )
            own = F.col("people")
            # the guest takes the place of the last; it leads if it is better
            state = state.join(guest, ["block", "island"]).select(
                "block", "island", "sizes",
                F.when(F.col("guest_bins") < F.col("bins"),
                       F.concat(F.array("guest"), F.slice(own, 1, POPULATION - 1)))
                .otherwise(F.concat(F.slice(own, 1, POPULATION - 1), F.array("guest")))
                .alias("people"),
                "bins", "bound",
            )
            if not state.where("bins > bound").limit(1).count():
                break
    return state.groupBy("block").agg(
        F.min_by(F.col("people")[0], F.struct("bins", "island")).alias("bins")
    )


def _place(rows: DataFrame, columns: list[str], capacity: int, level: int) -> DataFrame:
    """``rows`` with block, bin, fill of the bin and offset in it."""
    n = rows.count()
    blocks = max(1, -(-n // BLOCK))
    key = F.pmod(F.xxhash64(*columns), F.lit(blocks)).alias("block")
    items = rows.select(*columns, key)

    def sizes(frame: pd.DataFrame) -> pd.DataFrame:
        long = np.sort(frame.length.to_numpy())[::-1].astype(np.int32)
        return pd.DataFrame({"block": [frame.block.iloc[0]], "sizes": [long.tobytes()]})

    lengths = items.select("block", "length").groupBy("block").applyInPandas(
        sizes, "block bigint, sizes binary"
    )
    best = _search(lengths, blocks, capacity)

    def place(key, frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        bins = np.frombuffer(found.bins.iloc[0], np.int32)
        frame = frame.sort_values(["length", *[c for c in columns if c != "length"]],
                                  ascending=False, kind="stable")
        long = frame.length.to_numpy()
        order = np.argsort(bins, kind="stable")
        total = np.cumsum(long[order]) - long[order]
        first = np.searchsorted(bins[order], np.arange(bins.max() + 1))
        offset = np.empty(len(long), np.int64)
        offset[order] = total - total[first][bins[order]]
        fill = np.bincount(bins, long)[bins].astype(np.int64)
        return frame[columns].assign(
            sequence_id=(np.int64(level) << 60) + (np.int64(key[0]) << 20) + bins,
            offset=offset, fill=fill,
        )

    schema = ", ".join(f"{c} {t}" for c, t in items.select(*columns).dtypes)
    return items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
        place, f"{schema}, sequence_id bigint, offset bigint, fill bigint"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: pieces of one sequence lie
    gapless from offset 0 and fill at most ``capacity``.

    Takes any columns besides ``length``; those named sequence_id, offset,
    fill and block are replaced. Pieces as long as the capacity, or longer,
    have a sequence of their own. Null or negative lengths count as 0. An
    empty table gives an empty result. Rows that are equal in every column
    are separate pieces; to spread very many of them over blocks, give them a
    column that differs (``slot`` of :func:`token_pieces`)."""
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "fill", "block")]
    length = F.greatest(F.coalesce(F.col("length"), F.lit(0)), F.lit(0)).cast("bigint")
    rows = pieces.select(*columns).withColumn("length", length)
    whole = rows.where(F.col("length") >= capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    first = saved(_place(rows.where(F.col("length") < capacity), columns, capacity, 0), "packing")
    well = F.col("fill") >= REOPEN * capacity
    again = _place(first.where(~well).select(*columns), columns, capacity, 1)
    out = [*columns, "sequence_id", "offset"]
    return whole.unionByName(first.where(well).select(*out)).unionByName(again.select(*out))


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, pieces in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed_pieces.groupBy("sequence_id").agg(joined.alias("ids"))
