"""Connected components of a table of links, as joins and sums, and of a task's own links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """``links``: (a, b), longs. Returns (node, comp): comp is the smallest node of its component.

    Each round a node takes the smallest label among its neighbours' and its
    own, and then the label of that label, so long chains halve. A hub's links
    meet in partial minimums; nothing is gathered in one task. Rounds are
    written to the shared folder; their number grows with the logarithm of the
    longest chain.
    """
    edges = keep(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = keep(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        told = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("own"))
        jump = labels.select(F.col("node").alias("own"), F.col("comp").alias("next"))
        told = keep(told.join(jump, "own", "left").select("node", "old", F.least("own", "next").alias("comp")), "labels")
        if not told.filter("comp < old").limit(1).count():
            return told.select("node", "comp")
        labels = told.select("node", "comp")


def first_of_each(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a task as a star for each component: (node, its component's smallest node), without the smallest itself."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            rest = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[rest], nodes[label[rest]]
        label = new
