"""Connected components of an edge table, by smallest label and pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.llm.tables import staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for every end of an edge (columns ``a``, ``b``, long).

    Each round a node takes the smallest label among itself, its neighbours and the node its label names, so labels
    travel twice as far each time. The state of a round is a written table; only a count of changes reaches the
    driver. A hot node is a hot key of plain joins with a side of unique keys, which adaptive execution splits.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    state = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(state, both.b == state.node).groupBy("a").agg(F.min("label").alias("near"))
        seen = state.join(near, state.node == near.a).select("node", "label", F.least("label", "near").alias("seen"))
        of = state.select(F.col("node").alias("named"), F.col("label").alias("far"))
        following = staged(
            seen.join(of, seen.seen == of.named, "left").select("node", F.least("seen", "far").alias("label"), (F.least("seen", "far") < F.col("label")).alias("moved")),
            "labels",
        )
        state = following.select("node", "label")
        if following.where("moved").isEmpty():
            return state


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest place it is linked with, over links left-right."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return root
