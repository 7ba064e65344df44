"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them: the larger ones, or else the smaller ones."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    ends = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    ends = materialize(ends, "ends") if large else ends
    lows = materialize(ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")), "lows")
    moved = ends.join(lows, "u")
    if large:
        moved = moved.where("v > u")
    hung = moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        hung = hung.unionByName(lows.select("u", F.col("low").alias("v")))
    return materialize(hung.where("u <> v").distinct(), "stars")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (u, v) of numbers: root is the smallest node reachable.

    Alternates two steps until the edges stay as they are: every node hangs its larger neighbours, then its smaller
    ones, on the smallest neighbour.  The edges end as stars around the roots.  Rounds grow with the logarithm of the
    longest path.  Nothing but a count and a checksum of the edges comes to the driver; minima are combined before
    the shuffle, and the join that follows has bare scans on either side, whose hot partitions can be split.
    Loops and repeated edges do no harm; an empty table gives no rows.
    """
    edges = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        edges = _stars(_stars(edges, large=True), large=False)
        check = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == seen:
            break
        seen = check
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
