"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b); a component is its smallest node.

    Alternates two steps that keep components: every node hands its smallest neighbour to its
    larger ones, then to its smaller ones.  The rounds grow with the logarithm of the longest
    path; each is written to shared storage.  The minimum of a hub is combined before the
    shuffle, and joined back by a join that adaptive execution may split.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "links")
    state = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (found["n"], found["x"]) == state:
            break
        state = (found["n"], found["x"])
        back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = edges.unionAll(back).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        larger = back.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        larger = materialize(larger, "larger")
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        between = larger.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(least.select("a", F.col("m").alias("b")).unionAll(between).distinct(), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
