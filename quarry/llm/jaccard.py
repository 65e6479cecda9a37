"""N-gram Jaccard join: all links at or above a likeness, and their components.

A document's set is its distinct WORDS-word shingles (64-bit hashes). Texts of
equal sets are one node. Links are found without any comparison outside small
clusters:

1. **Universe partition.** Set sizes are cut into bands such that a set can
   only link inside its band and the next. For every pair of neighbouring bands, two linked
   sets differ in at most H elements, so when the universe is hashed into m >
   H segments, at least m - H segments of the two hold equal subsets
   (pigeonhole). Each set emits one signature per segment and band pair.
2. **Cost-based allocation.** Empty segments match anything, so they get
   nothing: the partition has as many extra segments as a set of the band has
   empty ones as a rule, and only a set with still more empty segments emits
   those as well. For sets of about SMALL elements or fewer, more signatures
   cost little and small segments tell little: they get half as many segments,
   twice as large, each with its one-deletion neighbourhood
   (:func:`deletion_signatures`). Sets that share a signature are then
   compared by their parity sketches (a bit is the parity of the elements
   hashed to it): where two sketches differ in more than H bits, so do the
   sets. What is left links sets to clusters. In a cluster over BLOCK nodes,
   elements that no other set of the cluster has are certain differences, and
   a set with more than H of them links with nothing and leaves.
3. **Exact verification.** Sets of a cluster meet in tasks of at most BLOCK
   sets, or of two blocks, and every pair of a task is verified on the sets
   themselves. Only links leave a task, as a spanning forest and link counts.

Copies, hot passages and large near-copy groups therefore never cause pairs to
be written out. Signatures shared by very many sets (over BUCKET) are streamed in
sorted order with constant memory and are not compared by sketches.

Defined results: null text, empty text and text without words have an empty
set, size 0, no link and are their own component, as is any row whose id is
null (component null unless copies or links have an id); a text of fewer words
than a shingle has one shingle, its whole sequence; repeated rows are copies
of each other. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (
    mix, saved, shingles, sliced, prepare, text_buffers, word_hashes,
)
from quarry.llm.components import connected

WORDS = 4
PERCENT = 85  # links: 100 * intersection >= PERCENT * union
BLOCK = 512  # sets verified with each other in one task
SMALL = 40  # elements up to which a set gets one-deletion neighbourhoods
BUCKET = 1 << 15  # nodes of one signature held at once
BLOCK_ELEMENTS = 1 << 24  # cells of the matrix multiplied at once
SLICE_BYTES = 1 << 20
SEEN = 1 << 16  # texts of a task remembered at once

_U = np.uint64


def element_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, offsets): the distinct shingle hashes of every text, sorted."""
    h, at = shingles(*word_hashes(data, offsets), k)
    sets = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), ends


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values``, modulo 2**64."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[ends[1:]] - total[ends[:-1]]


def set_hashes(elements: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every set."""
    n = np.diff(ends).astype(np.uint64)
    return (mix(_sums(mix(elements + _U(11)), ends) + n), mix(_sums(mix(elements ^ _U(1 << 40)), ends)))


# --- the partition of the universe ---


class Bands:
    """Size bands and, per pair of neighbouring bands, the segments."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.low, self.high = [1], [self._most(1)]

    def _most(self, n: int) -> int:
        """The largest size that can link with size n."""
        return n * 100 // self.percent

    def upto(self, n: int) -> None:
        while self.high[-1] < n:
            self.low.append(self.high[-1] + 1)
            self.high.append(self._most(self.low[-1]))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.upto(int(sizes.max(initial=1)))
        return np.searchsorted(np.array(self.high), sizes)

    def budget(self, a, b):
        """Most elements in which linked sets of sizes a and b can differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def pair(self, band: int) -> tuple[int, int]:
        """(H, extra segments) of sets in ``band`` with its own and the next."""
        self.upto(self.high[band] + 1)
        top = self.high[band]
        h = int(self.budget(top, self._most(top)))
        extra = int(2 * (h + 1) * np.exp(-self.low[band] / (h + 1))) if h else 0
        return h, extra


def _tag(number: int) -> np.uint64:
    return _U(number * 0x9E3779B97F4A7C15 % (1 << 64))


def deletion_signatures(x: np.ndarray, pair: int, h: int) -> np.ndarray:
    """Signatures of one set for a pair of bands with budget ``h``, with
    one-deletion neighbourhoods.

    A segment with its neighbourhood counts double, so h // 2 + 1 segments do:
    linked sets agree in one of them up to one element, which only one of the
    two has. The subset of a segment and the subset without any one element
    are hashed alike, so the two meet."""
    m = h // 2 + 1
    value = mix(x ^ _U(0x2545F4914F6CDD1D))
    segment = (mix(x + _U(pair + 7001)) % _U(m)).astype(np.int64)
    total = np.zeros(m, np.uint64)
    np.add.at(total, segment, value)
    tag = mix(np.arange(m, dtype=np.uint64) + _tag(pair + 7001))
    whole = mix(total ^ tag)
    if not h:  # linked sets are equal
        return whole
    return np.unique(np.concatenate([whole, mix((total[segment] - value) ^ tag[segment])]))


def signatures(
    elements: np.ndarray, ends: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of all sets of a batch; empty sets have none."""
    sizes = np.diff(ends)
    band = bands.of(sizes)
    out_sig, out_row = [], []
    for shift in (0, 1):  # as the smaller band of a pair, and as the larger
        pair = band - shift
        ok = (sizes > 0) & (pair >= 0)
        if shift:  # only if some size of the lower band is in reach
            high = np.array(bands.high)
            ok &= sizes * bands.percent <= 100 * high[np.maximum(pair, 0)]
        for p in np.unique(pair[ok]):
            rows = np.flatnonzero(ok & (pair == p))
            h, extra = bands.pair(int(p))
            if bands.low[int(p)] <= SMALL:
                for row in rows.tolist():
                    sig = deletion_signatures(elements[ends[row]:ends[row + 1]], int(p), h)
                    out_sig.append(sig)
                    out_row.append(np.full(len(sig), row))
                continue
            m = h + 1 + extra
            n = sizes[rows]
            at = np.repeat(ends[rows], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            x = elements[at]
            segment = (mix(x + _U(int(p) + 1)) % _U(m)).astype(np.int64)
            cell = np.repeat(np.arange(len(rows)) * m, n) + segment
            total = np.zeros(len(rows) * m, np.uint64)
            np.add.at(total, cell, mix(x ^ _U(0x5DEECE66D)))
            filled = np.bincount(cell, minlength=len(total)) > 0
            empty = m - filled.reshape(-1, m).sum(axis=1)
            use = filled | np.repeat(empty > extra, m)
            index = np.flatnonzero(use)
            tag = mix((index % m).astype(np.uint64) + _tag(int(p) + 1))
            out_sig.append(mix(total[index] ^ tag))
            out_row.append(rows[index // m])
    if not out_sig:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_row)


# --- parity sketches ---


def sketches(elements: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Of every set, a row of bits: each is the parity of the elements that
    hash to it. About as many bits as elements, a power of two; halves of a
    sketch added up give the sketch of half as many bits. Two sketches of one
    size differ in at most as many bits as the sets differ in elements."""
    sizes = np.diff(ends)
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(width)])
    h = mix(elements + _U(77001)).astype(np.int64) & np.int64(0x7FFFFFFFFFFFFFFF)
    at = np.repeat(start[:-1], sizes) + (h & (np.repeat(width, sizes) - 1))
    odd = (np.bincount(at, minlength=int(start[-1])) & 1).astype(np.uint8)
    flat = np.packbits(odd, bitorder="little").tobytes()
    return [flat[a // 8:b // 8] for a, b in zip(start[:-1].tolist(), start[1:].tolist())]


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """(rows, words) of 64 bits from wider rows."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def may_link(distance: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b with at least ``distance`` differences
    can be linked."""
    most = (a + b) * (100 - percent) // (100 + percent)
    return (distance <= most) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def reach(bits: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that connect whatever is connected by pairs that may link. Every
    set meets the sets not yet reached, once."""
    left = np.arange(len(sizes))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            v = todo.pop()
            d = np.bitwise_count(bits[left] ^ bits[v]).sum(axis=1, dtype=np.int64)
            ok = may_link(d, sizes[left], sizes[v], percent)
            new = left[ok].tolist()
            edges += [(v, x) for x in new]
            todo += new
            left = left[~ok]
    return edges


# --- verification ---


def links(sets: list[np.ndarray], percent: int, split: int | None = None) -> np.ndarray:
    """(i, j) rows of the linked pairs i < j; with ``split``, only pairs of a
    set before it and a set from it on."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n < 2:
        return np.empty((0, 2), np.int64)
    if n <= 4:
        found = []
        for i in range(n):
            for j in range(i + 1, n):
                if split is not None and not i < split <= j:
                    continue
                a, b = sizes[i], sizes[j]
                if 100 * min(a, b) < percent * max(a, b):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both and 100 * both >= percent * (a + b - both):
                    found.append((i, j))
        return np.array(found, np.int64).reshape(-1, 2)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    common = count[column] > 1
    row, column = row[common], column[common]
    _, column = np.unique(column, return_inverse=True)
    width = int(column.max()) + 1 if len(column) else 0
    both = np.zeros((n, n), np.float32)
    step = max(1, BLOCK_ELEMENTS // (4 * n))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, width, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        x = np.zeros((n, min(step, width - lo)), np.float32)
        x[row[a:b], column[a:b] - lo] = 1
        both += x @ x.T  # counts under 2**24: exact
    both = both.astype(np.int64)
    ok = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
    ok = np.triu(ok, 1)
    if split is not None:
        ok[:split, :split] = False
        ok[split:, split:] = False
    return np.argwhere(ok)


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs enough to connect what ``pairs`` connects."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs.tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[b] = a
            out.append((i, j))
    return out


# --- Spark ---


def text_key() -> list[Column]:
    """(h, g): two independent hashes of the text, null as empty; they stand
    for it where rows are told apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")]


def _hashed(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, node, check, bits, h, g) of every row; node 0:
    empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                elements, ends = element_sets(*text_buffers(part.column(1)), k)
                node, check = set_hashes(elements, ends)
                n = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n),
                     pa.array(np.where(n > 0, node, 0).astype(np.uint64).view(np.int64)),
                     pa.array(check.view(np.int64)), pa.array(sketches(elements, ends), pa.binary()),
                     part.column(2), part.column(3)],
                    names=["doc_id", "n_shingles", "node", "check", "bits", "h", "g"],
                )

    return docs.mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node bigint, check bigint, bits binary, "
        "h bigint, g bigint")


def _once(docs: DataFrame) -> DataFrame:
    """(h, g, text) of the rows, copies of a text in a task as a rule once: the
    copies of one text never make a large key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            if len(seen) > SEEN:
                seen.clear()
            yield batch.filter(pa.array(new, pa.bool_()))

    return docs.select("h", "g", "text").mapInArrow(run, "h bigint, g bigint, text string")


def _all_signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                elements, ends = element_sets(*text_buffers(part.column(1)), k)
                node, _ = set_hashes(elements, ends)
                _, once = np.unique(node, return_index=True)  # copies in a batch emit once
                keep = np.zeros(len(node), bool)
                keep[once] = True
                sig, row = signatures(elements, ends, bands)
                sig, row = sig[keep[row]], row[keep[row]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(node[row].view(np.int64))],
                    names=["sig", "node"],
                )

    return docs.mapInArrow(run, "sig bigint, node bigint")


def _held_groups(batches: Iterator[pa.RecordBatch], most: int):
    """Arrays of the columns, cut only between values of the first column,
    which comes sorted; a run of over ``most`` rows comes in parts. Yields
    (columns, whether the first run began before, whether the last goes on)."""
    held: list[pa.RecordBatch] = []
    goes_on = False
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks()
        first = whole.column(0).to_numpy()
        cut = int(np.searchsorted(first, first[-1]))  # the last run may go on
        if cut:
            yield whole.slice(0, cut), goes_on, False
            goes_on = False
        rest = whole.slice(cut)
        if rest.num_rows > most:
            yield rest, goes_on, True
            goes_on, held = True, []
        else:
            held = rest.to_batches()
    if held:
        yield pa.Table.from_batches(held), goes_on, False


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node, sure) of the signatures that two nodes or more have.
    Rows come sorted by signature and node. Equal sets of nodes are one
    bucket, whatever their signatures. Beyond BUCKET nodes a signature is not
    held: each of its nodes makes a ``sure`` bucket with the first one."""
    sig0 = first0 = None
    for table, goes_on, unfinished in _held_groups(batches, BUCKET):
        sig, node = (table.column(i).combine_chunks().to_numpy() for i in (0, 1))
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node = sig[keep], node[keep]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        sizes = np.diff(np.append(starts, len(sig)))
        if goes_on and sig[0] == sig0:
            n = int(sizes[0])
            head, node, sig = node[:n], node[n:], sig[n:]
            yield _sure(first0, head[head != first0])
            starts, sizes = starts[1:] - n, sizes[1:]
        if not len(starts):
            continue
        sig0, first0 = sig[-1], node[starts[-1]]
        large = sizes > BUCKET
        large[-1] |= unfinished
        for i in np.flatnonzero(large):
            yield _sure(node[starts[i]], node[starts[i] + 1:starts[i] + sizes[i]])
        sums = np.add.reduceat(mix(node.view(np.uint64)), starts)
        key = np.repeat(mix(sums + sizes.astype(np.uint64)), sizes)
        use = np.repeat((sizes > 1) & ~large, sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[use].view(np.int64)), pa.array(node[use]),
             pa.array(np.zeros(int(use.sum()), bool))], names=["bucket", "node", "sure"])


def _sure(first, nodes: np.ndarray) -> pa.RecordBatch:
    pair = np.column_stack([np.full(len(nodes), first), nodes]).astype(np.int64)
    key = mix(mix(pair[:, 0].view(np.uint64)) + _U(3)) ^ mix(pair[:, 1].view(np.uint64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(key, 2).view(np.int64)), pa.array(pair.ravel()),
         pa.array(np.ones(2 * len(nodes), bool))], names=["bucket", "node", "sure"])


def _edges(percent: int):
    """Rows (bucket, node, sure, n, bits) in order of bucket, to edges (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _, _ in _held_groups(batches, 2 * BUCKET):
            bucket, node, sure, n = (
                table.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(4))
            raw = table.column(4).combine_chunks()
            words = np.diff(np.frombuffer(raw.buffers()[1], np.int32)[
                raw.offset:raw.offset + len(raw) + 1]) // 8
            flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint64)
            at = np.cumsum(words) - words
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            sizes = np.diff(np.append(starts, len(bucket)))

            def bits(rows, wide, to):
                return folded(flat[at[rows][:, None] + np.arange(wide)], to)

            out: list[tuple[np.ndarray, np.ndarray]] = []
            two = starts[sizes == 2]
            for wa, wb in set(zip(words[two].tolist(), words[two + 1].tolist())):
                i = two[(words[two] == wa) & (words[two + 1] == wb)]
                to = min(wa, wb)
                d = np.bitwise_count(bits(i, wa, to) ^ bits(i + 1, wb, to)).sum(
                    axis=1, dtype=np.int64)
                i = i[may_link(d, n[i], n[i + 1], percent) | sure[i]]
                out.append((node[i], node[i + 1]))
            for s, k in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                rows = np.arange(s, s + k)
                to = int(words[rows].min())
                wide = np.empty((k, to), np.uint64)
                for w in set(words[rows].tolist()):
                    own = words[rows] == w
                    wide[own] = bits(rows[own], w, to)
                if pairs := reach(wide, n[rows], percent):
                    a, b = np.array(pairs).T
                    out.append((node[rows[a]], node[rows[b]]))
            if out:
                a, b = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _clusters(signed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component, size) of the nodes that share a signature with
    another that they may link to; ``size``: nodes of the cluster. Sizes are
    joined to these short rows, so that no text is ever dealt by its cluster."""
    met = signed.repartition("sig").sortWithinPartitions("sig", "node")
    buckets = met.mapInArrow(_buckets, "bucket bigint, node bigint, sure boolean").distinct()
    sketched = buckets.join(nodes.select("node", "n", "bits"), "node")
    dealt = sketched.select("bucket", "node", "sure", "n", "bits").repartition(
        "bucket").sortWithinPartitions("bucket", "node")
    found = saved(connected(dealt.mapInArrow(_edges(percent), "a bigint, b bigint")), "clusters")
    # written before the join, so that Spark can split a large cluster's rows
    sizes = saved(found.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    return saved(found.join(sizes, "component").select("node", "component", "size"), "sized")


_FOUND = "a bigint, b bigint, n_links bigint"


def _verified(tiles: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows of a tile (tile, side, node, copies, text) to a spanning forest of
    its links (a, b) and link counts (a, null, n_links). In a tile with both
    sides, only pairs across are verified."""
    ordered = tiles.repartition("tile").sortWithinPartitions("tile", "side", "node")

    def done(nodes, sides, copies, texts) -> pa.RecordBatch:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        elements, ends = element_sets(
            data, np.cumsum([0, *map(len, raw)]).astype(np.int64), k)
        sets = [elements[a:b] for a, b in zip(ends[:-1], ends[1:])]
        split = sides.index(1) if 0 in sides and 1 in sides else None
        pairs = links(sets, percent, split)
        copies = np.array(copies, np.int64)
        degree = np.zeros(len(sets), np.int64)
        np.add.at(degree, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(degree, pairs[:, 1], copies[pairs[:, 0]])
        tree = forest(len(sets), pairs)
        linked = np.flatnonzero(degree).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([nodes[i] for i, _ in tree] + [nodes[i] for i in linked], pa.int64()),
             pa.array([nodes[j] for _, j in tree] + [None] * len(linked), pa.int64()),
             pa.array([None] * len(tree) + degree[linked].tolist(), pa.int64())],
            names=["a", "b", "n_links"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])
        for batch in batches:
            for tile, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != now and held[0]:
                    yield done(*held)
                    held = ([], [], [], [])
                now = tile
                for x, to in zip((row[1], row[0], row[2], row[3]), held):
                    to.append(x)
        if held[0]:
            yield done(*held)

    return ordered.select("tile", "side", "node", "copies", "text").mapInArrow(run, _FOUND)


def _tiled(members: DataFrame) -> DataFrame:
    """Members (component, size, node, copies, text) of clusters over BLOCK
    nodes, dealt into blocks; one row per tile the member's block is in."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK / 2)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    at = members.select("component", "node", "copies", "text", blocks.alias("blocks"),
                        own.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return at.select("*", other.alias("other")).select(
        F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "copies", "text",
    )


def _without_isolated(members: DataFrame, k: int, percent: int) -> DataFrame:
    """``members`` without those that have more elements which no other member
    of their cluster has than linked sets can differ in; ``size`` counted
    again."""

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                elements, ends = element_sets(*text_buffers(part.column(2)), k)
                n = np.diff(ends)
                row = pa.array(np.repeat(np.arange(part.num_rows), n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row),
                     pa.array(np.repeat(n, n)), pa.array(elements.view(np.int64))],
                    names=["component", "node", "n", "element"],
                )

    each = saved(members.select("component", "node", "text").mapInArrow(
        exploded, "component bigint, node bigint, n bigint, element bigint"), "elements")
    common = each.groupBy("component", "element").agg(F.count("*").alias("sets"))
    kept = each.join(common.where("sets > 1").drop("sets"), ["component", "element"])
    most = F.expr(f"(n + n * 100 div {percent}) * {100 - percent} div {100 + percent}")
    stay = saved(
        kept.groupBy("component", "node", "n").agg(F.count("*").alias("shared"))
        .where(F.col("n") - F.col("shared") <= most).select("component", "node"), "stay")
    sizes = saved(stay.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    return members.drop("size").join(stay.join(sizes, "component").drop("component"), "node")


def join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs``.
    component_id: the smallest doc_id reachable by links; n_links: number of
    documents linked directly, copies included."""
    return grouped(docs, k, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def grouped(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The columns of :func:`join`, the text's (h, g) of :func:`text_key` and
    ``group``, one number for all rows of a component, with an id or without;
    null for empty sets, each of which is its own component."""
    prepare(docs.sparkSession)
    few = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *text_key(),
    )
    rows = saved(_hashed(few, k), "sets")
    filled = rows.where("node <> 0")
    nodes = saved(
        filled.groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"),
            F.min("check").alias("check"), F.max("check").alias("other_check"),
            F.min("n_shingles").alias("n"), F.max("n_shingles").alias("other_n"),
            F.min("bits").alias("bits"), F.min(F.struct("h", "g")).alias("key"),
        ), "nodes",
    )
    if nodes.where("check <> other_check OR n <> other_n").limit(1).count():
        raise ValueError("two sets share a 64-bit hash")

    clusters = _clusters(_all_signatures(few.select("doc_id", "text"), k, percent), nodes, percent)
    # one text a node, whatever ids its rows have: equal sets verify alike
    chosen = clusters.join(nodes.select("node", "copies", "key.h", "key.g"), "node")
    members = _once(few).join(chosen, ["h", "g"]).groupBy("h", "g").agg(*(
        F.first(c).alias(c) for c in ("component", "size", "node", "copies", "text")))
    members = saved(members.drop("h", "g"), "members")
    return _finished(rows, nodes, members, k, percent)


def _finished(
    rows: DataFrame, nodes: DataFrame, members: DataFrame, k: int, percent: int
) -> DataFrame:
    small, large = F.col("size") <= BLOCK, F.col("size") > BLOCK

    def one_tile(df):
        return df.select(F.col("component").alias("tile"), F.lit(0).alias("side"), "node",
                         "copies", "text")

    rest = saved(_without_isolated(members.where(large), k, percent), "rest")
    tiles = one_tile(members.where(small)).unionByName(
        one_tile(rest.where(small))).unionByName(_tiled(rest.where(large)))
    found = saved(_verified(tiles, k, percent), "links")

    edges = found.where("b IS NOT NULL").select("a", "b")
    reach = saved(connected(edges), "reach")
    counts = found.where("n_links IS NOT NULL").groupBy("a").agg(F.sum("n_links").alias("near"))
    least = saved(reach.join(nodes.select("node", "first_id"), "node").groupBy("component").agg(
        F.min("first_id").alias("least_id")), "least-ids")
    linked = reach.join(least, "component").select("node", "least_id", "component")
    known = nodes.join(linked, "node", "left").join(
        counts.withColumnRenamed("a", "node"), "node", "left"
    ).select(
        "node", F.coalesce("least_id", "first_id").alias("component_id"),
        F.coalesce("component", "node").alias("group"),
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
    )
    return rows.join(known, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "h", "g", "group",
    )
