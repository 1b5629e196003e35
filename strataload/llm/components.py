"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import discard, settle


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every linked node the smallest node it reaches.

    Alternates two steps until nothing changes: each node hands its larger neighbours to
    its smallest one, then its smaller ones. Minima combine on the map side and the joins
    are plain equi-joins, so a node with very many links is split by adaptive execution.
    The number of rounds grows with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = settle(edges, "links")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u > v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        old, edges = edges, settle(small.filter("u > v").distinct(), "links")
        discard(old, large)
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
