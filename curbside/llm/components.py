"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbside.workspace import staged


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) from rows (a, b): the smallest node reachable, for every linked node.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller ones. The number of links
    never grows and rounds grow with the logarithm of a component's width. A
    node's neighbours meet in an aggregate and a join, never in one list.
    """
    both = links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    now, before = staged(both.where("low < high").distinct(), "components"), None
    while (told := _told(now)) != before:
        before = told
        large = _to_smallest(now, larger_only=True)
        now = staged(_to_smallest(large, larger_only=False), "components")
    members = now.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return members.unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("root"))).distinct()


def _told(links: DataFrame) -> tuple:
    """What tells one set of links from another: their number and 128 bits of their hashes."""
    hashes = [F.bit_xor(F.xxhash64("low", "high", F.lit(seed))) for seed in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *hashes).first())


def _to_smallest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest of the node and its neighbours."""
    down = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    sides = down
    if larger_only:
        sides = down.unionByName(links.select(F.col("low").alias("node"), F.col("high").alias("other")))
    least = sides.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    met = sides.join(least, "node")
    if larger_only:
        moved = met.where("other > node").select(F.col("least").alias("low"), F.col("other").alias("high"))
    else:
        moved = met.select(F.col("least").alias("low"), F.col("other").alias("high")).unionByName(
            least.select(F.col("least").alias("low"), F.col("node").alias("high"))
        )
    return moved.where("low < high").distinct()
