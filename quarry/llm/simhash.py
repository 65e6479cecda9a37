"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has 64 bits: bit j is set if it is set in over half
of the XXH64 hashes (seed 42) of its 3-word shingles, repeats included. Texts
whose fingerprints differ in at most ``radius`` bits link, and documents are
grouped by the connected components of these links.

**Covering masks.** The 64 bits are dealt to the nonzero vectors of
F_2^(radius + 1), 7 of them for radius 2. Table v, for each nonzero v, keeps
the bits whose vector has an odd product with v. Whatever ``radius`` bits two
fingerprints differ in, some v is orthogonal to all their vectors; no differing bit
is kept in that table, and the two collide there. So every link is found, with
certainty, among the members of one bucket (table, kept bits).

**Hot buckets.** A bucket holds distinct fingerprints only, so copies never
fill one. Buckets of over ``bucket`` fingerprints are cut again by the same
construction over the bits that their table does not keep (27 or 28, then 12,
then 6 for radius 2): linked members differ in those bits alone, so again some
table brings them together. The free bits end below log2(bucket), where a
bucket cannot be larger than ``bucket``: no task ever holds more, and no
member is left out.

Inside a bucket fingerprints are compared exactly, and only a spanning forest
of the links leaves it.

Defined results: words are A-Z lower-cased runs of bytes other than ASCII
white space; a text of one or two words has one shingle, its whole sequence; a
null text or one without words has fingerprint zero and links like any other.
Rows of one id are separate documents. A row without an id belongs to its
component, which is named by its smallest id, null if it has none. Texts are
hashed in pieces of about PIECE bytes cut at white space, whatever their
length. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, prepare, saved
from quarry.llm.components import connected

BITS = 64
SEED = 42
WORDS = 3
RADIUS = 2
BUCKET = 512  # fingerprints that are compared with each other in one task
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in order, a piece of the text at a time."""
    lo = 0
    while lo < len(text):
        hi = lo + PIECE
        cut = _SPACE.search(text, hi) if hi < len(text) else None
        hi = cut.start() if cut else len(text)
        yield text[lo:hi].translate(LOWER).split()
        lo = hi


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, k: int = WORDS) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number."""
    counts, total, last = np.zeros(BITS, np.int64), 0, []
    for words in word_lists(text):
        last += words
        if len(last) >= k:
            shingles = [b" ".join(x) for x in zip(*(last[i:] for i in range(k)))]
            counts += _bit_counts(shingles)
            total += len(shingles)
            last = last[len(last) - k + 1:]
    if not total and last:
        counts, total = _bit_counts([b" ".join(last)]), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 k: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(t.as_py() or b"", k) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(each, "doc_id bigint, fp bigint")


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def covering(bits: list[int], radius: int) -> list[list[int]]:
    """The bits that each table of a covering of ``bits`` keeps."""
    n = 2 ** (radius + 1) - 1
    return [[b for i, b in enumerate(bits) if (i % n + 1 & v).bit_count() % 2]
            for v in range(1, n + 1)]


def refined(masks: list[int], radius: int) -> list[int]:
    """Masks of the next level: those of each table, cut by a covering of the
    bits that it does not keep. Children of table t begin at t times their
    number."""
    out = []
    for mask in masks:
        free = [b for b in range(BITS) if not mask >> b & 1]
        out += [mask | sum(1 << b for b in kept) for kept in covering(free, radius)]
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the fingerprints of a bucket."""
    fps = fps.astype(np.int64).view(np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    left = np.ones(len(fps), bool)
    edges = []
    for start in range(len(fps)):
        todo = [start] if left[start] else []
        left[start] = False
        while todo:
            at = todo.pop()
            met = np.flatnonzero(near[at] & left)
            left[met] = False
            todo += met.tolist()
            edges += [(at, i) for i in met.tolist()]
    own = fps.view(np.int64).tolist()
    return [(own[a], own[b]) for a, b in edges]


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` of ``nodes`` that
    join every two of distance ``radius`` or less, directly or by others."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for fps in batch.column(0)
                     for e in forest(fps.values.to_numpy(zero_copy_only=False), radius)]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    prepare(nodes.sparkSession)
    bucket = max(bucket, 2 ** (radius + 2))  # below that, masks no longer cut the free bits
    n = 2 ** (radius + 1) - 1
    masks, found = [0], None
    rows = nodes.select("fp", F.lit(0).alias("table"))
    while True:
        masks = refined(masks, radius)
        table = F.explode(F.sequence(F.col("table") * n, F.col("table") * n + n - 1))
        of = F.element_at(F.array(*(F.lit(_signed(m)) for m in masks)), F.col("table") + 1)
        keyed = rows.select("fp", table.alias("table")).select(
            "fp", "table", F.col("fp").bitwiseAND(of).alias("key"))
        # counted first: most fingerprints are alone, and a hot bucket costs a row a task
        sizes = saved(keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1"),
                      "simhash-buckets")
        met = keyed.join(sizes.where(F.col("n") <= bucket), ["table", "key"])
        edges = saved(
            met.groupBy("table", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
            .mapInArrow(compared, "a bigint, b bigint").distinct(), "simhash-links")
        found = edges if found is None else found.unionByName(edges)
        hot = sizes.where(F.col("n") > bucket)
        if hot.isEmpty():
            return found
        rows = saved(keyed.join(hot, ["table", "key"]).select("fp", "table"), "simhash-hot")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = saved(fingerprints(docs, id_column, text_column), "simhash-rows")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    member = connected(links(nodes, radius, bucket)).withColumnRenamed("node", "fp")
    linked = saved(nodes.join(member, "fp"), "simhash-linked")
    least = saved(linked.groupBy("component").agg(F.min("first").alias("least")), "simhash-least")
    named = linked.join(least, "component").select("fp", "least", F.lit(True).alias("linked"))
    place = saved(
        nodes.join(named, "fp", "left").select(
            "fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("first"))
            .alias("component_id")), "simhash-places")
    return rows.join(place, "fp").select(
        "doc_id", as_hex().alias("fingerprint"), "component_id")
