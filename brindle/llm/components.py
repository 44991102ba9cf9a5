"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brindle.session import free, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """`node, component` for every node of `links(a, b)`, written; the component is its smallest node.

    Alternates two steps until nothing changes, each one pass over the links: every node hands its
    smallest neighbour to its larger neighbours, then to its smaller ones. Links become stars whose
    centres merge, in a number of rounds that grows with the logarithm of the longest path. Each
    round is a written table, so a lost executor repeats one round at most. A node of very many
    links is only ever aggregated (combined before the exchange) and joined, where Spark splits it.
    """
    edges = links.select("a", "b").where("a != b")
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        # larger neighbours of a node are linked to the smallest of it and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        centre = materialize(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "n"),
            "centres",
        )
        large = (
            both.join(centre, both["a"] == centre["n"])
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = materialize(large, "large-stars")
        free(centre)
        # smaller neighbours of a node, and itself, are linked to the smallest of them
        centre = materialize(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), "centres")
        joined = large.join(centre, large["a"] == centre["n"])
        small = (
            joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .distinct()
        )
        small = materialize(small, "small-stars")
        free(centre, large)
        done = _sum(small) == _sum(edges)
        free(edges)
        edges = small
        if done:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    stars = materialize(
        stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "stars"
    )
    free(edges)
    return stars


def _sum(edges: DataFrame) -> tuple:
    """Tells two sets of links apart: their number and the sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(30,0)"))).first())
