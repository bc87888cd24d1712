"""Connected components of a graph given by links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``component`` (smallest node) of every node in ``links`` (a, b).

    Every round hangs the neighbours of a node, and itself, below the smallest of them, first for larger neighbours
    and then for smaller ones, until all links point to a component's smallest node. Rounds grow with the logarithm
    of the longest path. Each is written, so no lineage piles up.
    """
    links = stored(_directed(links.where("a != b")), f"links-{label}")
    while True:
        larger = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).select(
            F.col("hi").alias("node"), F.col("lo").alias("other"))
        least = larger.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("top"))
        hung = larger.join(least, "node").where("other > node").select(
            F.col("other").alias("a"), F.col("top").alias("b"))
        linked = stored(_directed(hung), f"large-{label}")
        top = linked.groupBy("hi").agg(F.min("lo").alias("top"))
        small = linked.join(top, "hi").select(F.col("lo").alias("a"), F.col("top").alias("b")).unionByName(
            top.select(F.col("hi").alias("a"), F.col("top").alias("b")))
        after = stored(_directed(small.where("a != b")), f"small-{label}")
        done = after.exceptAll(links).isEmpty() and links.exceptAll(after).isEmpty()
        links = after
        if done:
            break
    lowest = links.select(F.col("lo").alias("node")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        lowest.select("node", F.col("node").alias("component")))


def _directed(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
