"""Connected components as Spark jobs over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(id, component) for every end of an edge (src, dst); the component is its smallest id.

    Every round hooks each node to its smallest neighbour, follows these links to
    their roots and contracts the edges to roots.  A node that is not the smallest among its
    neighbours disappears, so at least half of the nodes do, and nothing but counts reaches the
    driver.  Null ends and loops are ignored; without edges the result is empty."""
    scratch = Scratch(edges.sparkSession, what)
    edges = scratch.keep(edges.where("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges0")
    mapping, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        ends = edges.select(F.col("src").alias("id"), F.col("dst").alias("to")).union(edges.select("dst", "src"))
        roots = scratch.keep(ends.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("root")), f"roots{turn}.0")
        jump = 0
        while True:
            jump += 1
            up = roots.select(F.col("id").alias("root"), F.col("root").alias("above"))
            jumped = scratch.keep(roots.join(up, "root").select("id", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), f"roots{turn}.{jump}")
            roots = jumped.select("id", "root")
            if jumped.where("moved").isEmpty():
                break
        a, b = roots.toDF("src", "a"), roots.toDF("dst", "b")
        edges = scratch.keep(edges.join(a, "src").join(b, "dst").where("a != b")
                             .select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct(), f"edges{turn}")
        if mapping is None:
            mapping = roots
        else:
            above = roots.toDF("root", "above")
            mapping = scratch.keep(mapping.join(above, "root", "left").select("id", F.coalesce("above", "root").alias("root")), f"mapping{turn}")
    if mapping is None:
        mapping = edges.select(F.col("src").alias("id"), F.col("dst").alias("root"))
    return mapping.select("id", F.col("root").alias("component"))
