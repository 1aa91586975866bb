"""Connected components of a graph of links, by alternating star steps.

Each round two steps shorten the paths: every node hands its larger neighbours to the smallest node it
knows, then its smaller ones. Rounds end when the links don't change any more; they then are stars around
the smallest node of each component. The number of rounds grows with the logarithm of the
longest path. Only links travel: no node's neighbours are ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import stored


def to_smallest(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over links (a, b) with a > b."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if larger else links
    least = seen.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = seen.join(least, "a")
    if larger:  # each larger neighbour is linked to the smallest node known here
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:  # the node itself and its other smaller neighbours are
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node that can be reached."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    links = stored(links.distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        links = stored(to_smallest(to_smallest(links, larger=True), larger=False), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
