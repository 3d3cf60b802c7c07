"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluicebox.llm.common import written


def _compressed(pointers: DataFrame) -> DataFrame:
    """Follow `node -> parent` to the roots, doubling the step each time."""
    while True:
        above = pointers.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        longer = written(
            pointers.join(above, "parent", "left")
            .select("node", F.coalesce("above", "parent").alias("parent"), (F.col("above") < F.col("parent")).alias("moved")),
            "pointers",
        )
        pointers = longer.select("node", "parent")
        if longer.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """`node, label` for every node of `edges (a, b)`; the label is the smallest node of its component.

    Each round points every node to its smallest neighbour, follows the pointers to their roots and
    contracts the graph to the roots. A round leaves no root next to a smaller one, so the number of
    rounds grows with the logarithm of the nodes; the driver sees only whether edges are left.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.select(F.inline(F.array(
            F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
        )))
        least = ends.groupBy("node").agg(F.min("other").alias("other"))
        pointers = _compressed(written(least.select("node", F.least("node", "other").alias("parent")), "pointers"))
        if labels is None:
            labels = pointers.select("node", F.col("parent").alias("label"))
        else:
            moved = pointers.select(F.col("node").alias("label"), F.col("parent").alias("root"))
            labels = written(labels.join(moved, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")
        a = pointers.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        b = pointers.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        left = edges.join(a, "a").join(b, "b").select(
            F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")
        )
        edges = written(left.where("a < b").distinct(), "edges")
    return labels
