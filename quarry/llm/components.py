"""Connected components of an edge table by alternating star contraction.

Every round re-hangs neighbours onto the smallest node they meet (large stars
onto larger neighbours, then small stars onto smaller ones), so the depth of a
component falls by a constant factor. Minima are aggregated before the
shuffle and written before they are joined, so that the edges of a hub are split
at run time; no component is ever brought together. Every round is a table in
the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round over edges (u, v); returns edges (u, v) with u > v."""
    if large:  # all neighbours
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # neighbours no larger than the node
        near = edges.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
    # a table: joined as an aggregate it would keep its own dealing, and Spark
    # could not split the edges of a hub
    least = saved(near.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    ), "least")
    met = near.join(least, "u")
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b, both bigint): the
    smallest node of its component. Self-loops and repeats do no harm."""
    now = saved(
        edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL").distinct(), "edges",
    )
    loops = now.where("u = v").select("u")
    links = now.where("u <> v")
    state = None
    while True:
        links = saved(_star(_star(links, True), False), "stars")
        # done when every node hangs on a root: no node is both
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    found = links.groupBy("u").agg(F.min("v").alias("component")).select(
        F.col("u").alias("node"), "component"
    )
    roots = links.select(F.col("v").alias("node")).unionByName(
        loops.select(F.col("u").alias("node"))
    ).distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(roots)
