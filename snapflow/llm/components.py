"""Connected components of a graph given by its edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.sources.tables import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every edge moves towards the least node.

    `edges` (a, b) lead from a larger node to a smaller one. The least neighbour is an
    aggregate, and joined back, so that a node with very many edges is never gathered.
    """
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = ways.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.filter("a > b").unionByName(kept).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The least node that each node of `edges` (a, b) is connected to: (node, root).

    Self-loops and repeats are allowed; edges with a null end are left out. Each round is
    written to the shared folder. The number of rounds grows with the logarithm of the
    longest path; an error is raised if `most_rounds` do not do.
    """
    edges = settle(
        edges.filter("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    alone = edges.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("root"))
    links = edges.filter("a > b")
    before = None
    for _ in range(most_rounds):
        # Edges are unchanged when all point at a root: then no node is both.
        sign = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if (sign["n"], sign["s"]) == before:
            break
        before = (sign["n"], sign["s"])
        if sign["n"] == 0:
            break
        links = settle(_round(links), "links")
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root")
    return found.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))
