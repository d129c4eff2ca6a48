"""Connected components of links between long keys, as a loop of Spark jobs.

Each round has two steps (large star and small star): every node looks at its neighbours and links them, and itself, to
the smallest of them. Links become stars around the least node of each component in a number of rounds that grows with
the logarithm of the longest path. The links of a round are written to the shared scratch folder, so lineage stays short
and a lost executor costs no more than its part of a round. A node with very many neighbours is an ordinary key of a
join, whose partitions Spark can split; minima are combined before they are shuffled. Nothing is sent to the driver but
a count and a sum that tell whether a round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapline.llm.common import drop_staged, staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b) after one step."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = both.join(least, "a")
    if large:
        return met.where("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    moved = met.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; links are two long columns, the component its least node.

    Links of a node to itself and links with a null are ignored, repeated ones count once. No links give no rows.
    """
    x, y = (F.col(c) for c in links.columns[:2])
    now = staged(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links")
    seen = None
    while True:
        # Equal counts and sums of a mixed hash: equal sets of links.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b")).distinct()
        seen, then = state, now
        now = staged(_star(_star(now, True), False), "links")
        drop_staged(then)
