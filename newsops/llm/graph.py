"""Connected components of links between documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsops.session import materialise


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it
    can reach.  Null ends and self-links are ignored.

    Large-star and small-star steps in turn: each node's neighbours are tied to
    the least of them, until nothing changes; rounds grow with the logarithm of
    the longest path.  Every round is a written table."""
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = materialise(ends.distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # Written, so that a hub's rows can be split among tasks in the join.
        least = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "links-least")
        large = materialise(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "links-large")
        floor = materialise(large.groupBy("hi").agg(F.min("lo").alias("m")), "links-floor")
        small = large.join(floor, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = materialise(small.unionAll(floor.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
