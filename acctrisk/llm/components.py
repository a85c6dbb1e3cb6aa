"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise, salted_join

SALTS = 8


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node that is not a root.

    links: a and b, in any order, repeated or not; a link of a node with itself says nothing.
    Every round lets each node hand its larger neighbours, then its smaller ones, to the smallest
    neighbour, until all links end at roots; the number of links never grows. Each round is
    written to the shared folder. Smallest neighbours are found by partial sums, and the links of
    a node with very many neighbours are dealt over salted partitions.
    """
    links = materialise(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .where("node <> root").distinct())
    state = _state(links)
    while True:
        links = materialise(_small_star(_large_star(links)))
        before, state = state, _state(links)
        if state == before:
            return links


def _state(links: DataFrame) -> tuple:
    """Count and checksum; rounds that change nothing leave them as they are."""
    marks = F.xxhash64("node", "root")
    return tuple(links.agg(F.count("*"), F.bit_xor(marks), F.sum(marks.bitwiseAND(0xFFFFFFFF)))
                 .first())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the smallest neighbour, itself counted."""
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    larger = both.where("root > node")
    return salted_join(larger, least, ["node"], "root", SALTS, "inner").select(
        F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, go to the smallest neighbour."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = salted_join(links, least, ["node"], "root", SALTS, "inner").select(
        F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root")
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct()
