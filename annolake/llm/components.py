"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands the smallest node around it to its larger (or to its smaller) neighbours."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    told = around.join(smallest, "a")
    if large:
        told = told.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        told = told.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return told.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``, longs); the root is the smallest node.

    Self-loops and repeated edges do no harm; no edges give an empty table.  Each round is written
    to the shared folder, and the number of rounds grows with the logarithm of the nodes.
    """
    current, before = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges"), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        current = stage(_star(_star(current, large=True), large=False), "edges")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(members.select(F.col("root").alias("node"), "root").distinct())
