"""Connected components by alternating large-star and small-star steps, in DataFrame functions.

A step replaces each node's links by links to the smallest node it sees. The two reduce to a minimum by key (aggregated before the
shuffle) and a join of the links with those minima; both join sides are plain exchanges, so that adaptive execution can split the
links of a hot node. Links are materialised in the shared folder after every step; nothing but two numbers a round reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import settled


def _to_smallest(links: DataFrame) -> DataFrame:
    """(u, v, m): every link with the smallest node among u and what u is linked with."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(settled(smallest), "u")


def _fingerprint(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node in `edges` that is linked with another; root is the smallest node reachable. Loops, repeated
    and reversed edges are harmless; an edge with a null end is none; no edges give no rows. The rounds grow with the logarithm of
    the longest chain; more than `max_rounds` raise an error and never give half-joined components."""
    pair = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    links = settled(pair.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large)
        small = _to_smallest(large)
        down = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = settled(down.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = _fingerprint(links)
        if now == before:
            # Stable links form stars: every node names its root, and roots name none.
            roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
