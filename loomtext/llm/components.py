"""Connected components of an edge table, by alternating large and small stars.

Each round points every node's neighbours at the smallest node it sees; all steps are group minima
with a map-side combine and joins on the node, so a node of very many edges is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its component.

    `edges` has `a` and `b` of one ordered type. Loops, repeated edges and both directions are
    allowed; null ends are not. No edges give no rows.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        now = stored(small_star(large_star(now)), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(roots)
