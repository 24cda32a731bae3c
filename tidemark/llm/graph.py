"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a``, ``b``); the root is the smallest node reachable.

    Union by stars: in turn, every node hands its larger neighbours, then its smaller
    ones, to the smallest node next to it, until nothing moves. Only the two ends of a
    link travel, the minimum is combined before the shuffle, and every round is written
    to the shared folder, so a lost executor costs one round at most. Nulls, loops and
    repeated links are left out; no links give no rows.
    """
    spark = links.sparkSession
    pairs = links.where("a is not null and b is not null and a != b")
    edges = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # Each node's larger neighbours are joined to the smallest of its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u != v").distinct()
        # Each node and its smaller neighbours are joined to the smallest of these.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
        edges = written(small.where("u != v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
