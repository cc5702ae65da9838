"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.storage import stored


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40))), F.sum(F.pmod(F.hash("u", "v"), F.lit(2**30)))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the smallest node reachable.

    Large-star and small-star in turn: each node's neighbours are tied to the
    smallest of them, until every node hangs on its component's smallest one.
    Rounds grow with the logarithm of the longest chain. Smallest neighbours are
    aggregated before they are shuffled; each round's links are written to the
    shared folder. Null ends, loops and repeated links are left out; no links
    give no rows.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "links")
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(small.union(lowest.select("u", F.col("low").alias("v"))).distinct(), "links")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
