"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from faresettle.llm.staging import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `edges` (`a`, `b`) but the roots; the root is the smallest node reachable.

    Nulls and self-edges are ignored, repeated edges do no harm, no edges give no rows. A node's
    neighbours never meet in one task: each round takes minima, which Spark sums up before its
    shuffle, and joins them back, which it splits when skewed.
    """
    stars = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
    before = None
    while (now := _signature(stars)) != before:
        before = now
        if not now[0]:
            break
        stars = checkpointed(_small_star(_large_star(stars)))
    return stars


def _signature(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "root")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.join(least, "node")
        .where("root > node AND root <> least")
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    moved = edges.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(least.withColumnRenamed("least", "root")).distinct()


class Forest:
    """Components of pairs met inside one task, so that it emits a star instead of all pairs."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[left], label[right]
            differ = a != b
            if not differ.any():
                return
            left, right, a, b = left[differ], right[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label[:] = jumped
