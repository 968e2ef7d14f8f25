"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from reviewlab.scratch import discard, stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); the root is the smallest node.

    Large-star and small-star steps in turn until nothing changes. Each step replaces
    links by links to the smallest neighbour, so the number of links never grows, and
    smallest neighbours are combined before the shuffle, so a node with very many
    links costs one row per task. Each round is a written table, which takes the place of
    the one before; what tells whether it changed is counted from it.
    """
    links = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    seen = _print(links)
    while seen["n"]:
        before, links = links, stage(_small_star(_large_star(links)), "links")
        discard(before)
        now = _print(links)
        if now == seen:
            break
        seen = now
    links = links.distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _print(links: DataFrame) -> Row:
    """A number of rows and a sum that change when the links do."""
    return links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)).alias("prints"),
    ).first()


def _large_star(links: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))
