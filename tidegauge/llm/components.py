"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stored


def _renamed(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges between the roots of their ends, without loops. Ends without a root stay."""
    u = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    v = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    return (
        edges.join(u, "u", "left").join(v, "v", "left")
        .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
        .where("u <> v")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    )


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` for all nodes with a link to another; a component has one root.

    ``links`` has columns ``a`` and ``b``. In each round every node joins its smallest neighbour,
    and what is left are the links between the nodes that others joined: at most half as many nodes
    as before, so the rounds grow with the logarithm of the largest component. A node may have any
    number of neighbours: only minima are grouped. Each round is written to the shared folder.
    """
    edges = stored(
        links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .where("u < v").distinct(), f"{label}-edges",
    )
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = stored(
            both.groupBy("u").agg(F.min("v").alias("v"))
            .select(F.col("u").alias("node"), F.least("u", "v").alias("root")), f"{label}-nearest",
        )
        # Two steps at once: a node joins what its smallest neighbour joins.
        further = nearest.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = nearest.join(further, "root").select("node", F.col("next").alias("root"))
        labels = stored(roots if labels is None else _relabelled(labels, roots), f"{label}-labels")
        edges = stored(_renamed(edges, roots), f"{label}-edges")
        if edges.isEmpty():
            return labels


def _relabelled(labels: DataFrame, roots: DataFrame) -> DataFrame:
    moved = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def joined_labels(labels: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """The components when further links are added to those of ``labels``."""
    links = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")), f"{label}-links")
    if links.isEmpty():
        return labels
    between = _renamed(links, labels).select(F.col("u").alias("a"), F.col("v").alias("b"))
    merged = components(between, label)
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return stored(_relabelled(labels, merged).unionByName(fresh), f"{label}-joined")
