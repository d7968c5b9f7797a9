"""Connected components of links between classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import written


def local_forest(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Of links met in one place, those that join something new."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b in zip(left, right, strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in (a, b) links; the component is its smallest node.

    Alternating large and small stars: every node links its larger neighbours, then its
    smaller ones, to the smallest node around it, until nothing changes.  Rounds grow with
    the logarithm of the longest path; each is a table in the shared folder.  A node with
    very many links has its minimum combined before the exchange, and adaptive execution
    splits the join.
    """
    edges = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        edges = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    stars = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
