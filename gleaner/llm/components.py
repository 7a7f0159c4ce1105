"""Connected components of an edge table, without bringing edges to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _apart(edges: DataFrame) -> DataFrame:
    """(a, b) once each, a < b."""
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a != b").select(*ends).distinct()


def _roots(edges: DataFrame) -> DataFrame:
    """(node, parent): every node hooks on its least neighbour below it, and follows to the end."""
    below = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
    parents = stage(below, "parents")
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        moved = parents.join(up, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("on")
        )
        moved = stage(moved, "parents")
        parents = moved.select("node", "parent")
        if not moved.where("on").limit(1).count():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge (a, b).

    Each round every node hooks on its least neighbour if that is smaller, paths are shortened to
    their roots, and the edges are drawn again between the roots; those inside a tree are gone. What
    is left after two rounds has each taken in one neighbour at least, so these halve the nodes. All
    tables of a round are written, so it does not depend on executors.
    """
    current = stage(_apart(edges), "edges")
    ends = current.select(F.col("a").alias("node")).unionAll(current.select("b")).distinct()
    labels = stage(ends.withColumn("component", F.col("node")), "labels")
    while current.limit(1).count():
        roots = _roots(current)
        labels = stage(relabelled(labels, roots), "labels")
        current = stage(_apart(between(current, roots)), "edges")
    return labels


def relabelled(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, component) with components moved to where roots (node, parent) say."""
    to = roots.select(F.col("node").alias("component"), "parent")
    return labels.join(to, "component", "left").select(
        "node", F.coalesce("parent", "component").alias("component")
    )


def between(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges (a, b) between the parents of their ends."""
    for end in ("a", "b"):
        to = roots.select(F.col("node").alias(end), F.col("parent").alias("_to"))
        other = "b" if end == "a" else "a"
        edges = edges.join(to, end, "left").select(F.coalesce("_to", end).alias(end), other)
    return edges


def with_edges(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The labels (node, component) after more edges: only these are looked at, between components."""
    if labels is None:
        return components(edges)
    known = labels.select("node", F.col("component").alias("parent"))
    found = components(between(edges, known)).select("node", F.col("component").alias("parent"))
    fresh = found.select("node").join(labels, "node", "left_anti")
    every = labels.unionByName(fresh.select("node", F.col("node").alias("component")))
    return stage(relabelled(every, found), "labels")
