"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import dropped, written


def _jumped(parents: DataFrame) -> DataFrame:
    """Parents replaced by the end of their chain. Each pass halves the chains."""
    spark, old = parents.sparkSession, None
    while True:
        up = parents.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
        step = parents.join(up, "parent", "left").select(
            "child", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
        )
        step, path = written(step, "chains")
        if old:
            dropped(spark, old)
        parents, old = step.select("child", "parent"), path
        if step.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that occurs in ``links`` (``a, b``, two longs); ``root`` is the
    smallest node of its component.

    Every node with a smaller neighbour is hung below its smallest one, the chains are shortened, and
    the links are restated between roots, until none is left. No group is gathered anywhere: sums and
    joins by node only. A NULL or a link to itself is ignored.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, _ = written(pairs.where("a < b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        parents, _ = written(
            edges.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent")), "parents"
        )
        parents = _jumped(parents)
        if labels is None:
            nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
            labels = nodes.withColumn("root", F.col("node"))
        above = parents.select(F.col("child").alias("root"), F.col("parent"))
        moved = labels.join(above, "root", "left")
        labels, _ = written(moved.select("node", F.coalesce("parent", "root").alias("root")), "labels")
        low = parents.select(F.col("child").alias("a"), F.col("parent").alias("pa"))
        high = parents.select(F.col("child").alias("b"), F.col("parent").alias("pb"))
        ends = edges.join(low, "a", "left").join(high, "b", "left")
        ends = ends.select(F.coalesce("pa", "a").alias("x"), F.coalesce("pb", "b").alias("y"))
        left = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges, _ = written(left.distinct(), "links")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
