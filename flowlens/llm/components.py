"""Connected components by contraction, in written steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` of each node of the edges (``a``, ``b``): equal labels mean connected.

    Each step gives a node the least of itself and its neighbours as label and goes on with the edges between labels.
    Ids without relation to the edges make steps few. Every step is a table in the shared folder, so the lineage does not
    grow. Loops and repeated edges change nothing; no edges give no rows.
    """
    edges = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stage(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.first("a"), F.min("b")).alias("label")), "step")
        labels = step if labels is None else relabel(labels, step)
        at_a = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        at_b = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = stage(edges.join(at_a, "a").join(at_b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
                      .where("a <> b").distinct(), "edges")
    return labels


def relabel(labels: DataFrame, step: DataFrame) -> DataFrame:
    """``labels`` after the labels themselves got the labels of ``step``; staged. Nodes only in ``step`` are added."""
    then = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    moved = labels.join(then, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return stage(moved.unionAll(step.join(labels, "node", "left_anti").select("node", "label")), "labels")
