"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, materialise


def _few(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The components of all edges of one task."""
    parts = list(it)
    if not parts:
        return
    ends = np.concatenate([np.concatenate([p["a"].to_numpy() for p in parts]), np.concatenate([p["b"].to_numpy() for p in parts])])
    nodes, at = np.unique(ends, return_inverse=True)
    a, b = np.split(at, 2)
    label = np.arange(len(nodes))
    while True:
        # Roots take the smallest root across an edge; then every node takes its root's root.
        low, before = np.minimum(label[a], label[b]), label.copy()
        for end in (a, b):
            np.minimum.at(label, label[end], low)
            np.minimum.at(label, end, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    yield pd.DataFrame({"node": nodes, "root": nodes[label]})


def components(edges: DataFrame, few: int = 0) -> DataFrame:
    """(a long, b long) -> (node, root): root is the smallest node of the component.

    Up to ``few`` edges are counted and then worked out in one task, which saves the rounds' many small jobs; the result is the same.

    Each round points every node at its smallest neighbour, shortens the pointers
    until they end at roots, and contracts the graph to the roots; every root
    takes in a neighbour or more, so the nodes at least halve. All state is in shared tables
    and every step joins or aggregates by node; the driver sees counts only.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if few and edges.count() <= few:
        return materialise(edges.coalesce(1).mapInPandas(_few, "node long, root long"), "labels")
    labels = None
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
        up = materialise(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "up")
        while True:
            far = up.select(F.col("u").alias("p"), F.col("p").alias("q"))
            jumped = materialise(up.join(far, "p", "left").select("u", F.coalesce("q", "p").alias("p"), (F.coalesce("q", "p") != F.col("p")).alias("moved")), "up")
            moved = jumped.where("moved").limit(1).count()
            discard(up)
            up = jumped.select("u", "p")
            up._quire_path = jumped._quire_path
            if not moved:
                break
        to_a = up.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        to_b = up.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        smaller = edges.join(to_a, "a").join(to_b, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        smaller = materialise(smaller, "edges")
        if labels is None:
            new = materialise(up.select(F.col("u").alias("node"), F.col("p").alias("root")), "labels")
        else:
            step = up.select(F.col("u").alias("root"), "p")
            new = materialise(labels.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root")), "labels")
            discard(labels)
        discard(edges, up)
        labels, edges = new, smaller
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
