"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtide.session import FEW_ROWS, compacted, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge.

    Each round a node takes the smallest label among its neighbours and then the
    label of that label, so paths shorten by half or more. Labels are written out
    each round, which cuts the lineage and survives lost executors. Minima are
    combined map-side, so a node with very many neighbours costs its task one row
    per other task. A few edges are worked on in one partition, without shuffles. Self-edges are allowed, NULL ends are ignored.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    both, rows = compacted(pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())

    def written(df: DataFrame) -> DataFrame:
        # No frame here has more rows than ``both``.
        return materialize(df).coalesce(1) if rows <= FEW_ROWS else materialize(df)

    labels = written(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
            .withColumnRenamed("a", "node")
        )
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("c"))
        up = labels.select(F.col("node").alias("c"), F.col("component").alias("up"))
        new = written(step.join(up, "c", "left").select("node", "old", F.least("c", "up").alias("component")))
        done = new.filter(F.col("component") != F.col("old")).isEmpty()
        labels = new.select("node", "component")
        if done:
            return labels


def merged_components(parts: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``parts`` (node, component) after ``edges`` have been added, with the new nodes among them.

    Edges are taken between the components that they join, so the rounds run over new
    edges only, however many lie behind ``parts``.
    """
    up = parts.select(F.col("node").alias("_node"), F.col("component").alias("_up"))

    def lifted(edges: DataFrame, end: str) -> DataFrame:
        return edges.join(up, edges[end] == up["_node"], "left").withColumn(end, F.coalesce("_up", end)).drop("_node", "_up")

    between, _ = compacted(lifted(lifted(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna(), "a"), "b").distinct())
    top = connected_components(between)
    moved = top.select(F.col("node").alias("component"), F.col("component").alias("_top"))
    old = parts.join(moved, "component", "left").select("node", F.coalesce("_top", "component").alias("component"))
    # A top node that no part holds is new; one that is a part's label stands in ``old`` already.
    return compacted(old.unionByName(top.join(parts.select("node"), "node", "left_anti")))[0]
