"""Connected components: in one task with numpy, or of a table of links with joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.shared import cut


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of ``n`` nodes is connected with."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes: each node with the least it is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(at[: len(a)], at[len(a) :], len(nodes))
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for each node of
    ``links`` (a, b) but the roots.

    Turns by turns a node's larger neighbours, then its smaller ones and itself, are
    linked with the least of all, until only stars are left. Each turn sums to a row
    per node before it joins, and a node with very many links is split in that join.
    """
    edges = cut(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        # Larger neighbours to the least neighbour.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = (
            both.join(least, "a")
            .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("least")))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        # Smaller neighbours and the node itself to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "least"), F.struct(F.col("b").alias("a"), "least")))
            .alias("link")
        )
        edges = cut(
            small.select(F.col("link.a").alias("a"), F.col("link.least").alias("b"))
            .where("a != b")
            .distinct()
        )
        sums = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if sums == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = sums
