"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.storage import Scratch

#: Up to so many links one task does a round without any shuffle; beyond, rounds are distributed.
FEW = 500_000


def roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row of its component."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        low = np.minimum(low, root)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours linked to the smallest one, the node included."""
    a, b = F.col("a"), F.col("b")
    both = edges.select(F.explode(F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(b.alias("a"), a.alias("b")))).alias("e")).select("e.a", "e.b")
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(low, "a").where(b > a).select(b.alias("a"), F.col("low").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours linked to the smallest of these."""
    a, b = F.col("a"), F.col("b")
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    both = F.array(F.struct(b.alias("a"), F.col("low").alias("b")), F.struct(a.alias("a"), F.col("low").alias("b")))
    return edges.join(low, "a").select(F.explode(both).alias("e")).select("e.a", "e.b").where(a != b).distinct()


def components(spark: SparkSession, links: DataFrame, scratch: Scratch, few: int = FEW) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b): the smallest node that links reach, itself included.

    Loops and null ends are ignored. Each round sends every node's neighbours to the smallest one, so that the number of
    rounds grows with the logarithm of a component's width. The minimum is summed before the shuffle and joined back, so
    a hub with a third of all links is split like any skewed join. Nothing goes to the driver but a count and a checksum.
    """
    a, b = F.col("a"), F.col("b")
    edges = scratch.cut(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        if mark[0] <= few:
            after = scratch.cut(_small(_large(edges.coalesce(1)).coalesce(1)).coalesce(1))
        else:
            large = scratch.cut(_large(edges))
            after = scratch.cut(_small(large))
            scratch.drop(large)
        scratch.drop(edges)
        edges, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return edges.select(a.alias("node"), b.alias("component")).unionByName(edges.select(b.alias("node"), b.alias("component")).distinct())
