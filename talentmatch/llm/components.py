"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a ``min`` aggregate and a join on the node, so a node with a third of all edges is
combined before the shuffle and its join is split by adaptive execution. Each round is written to
the shared folder, which cuts the plan and survives lost executors; the round before it is removed.
The rounds end with the first that leaves stars only, which one aggregate by node tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.session import release_path, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and itself, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every larger end (a) of ``edges`` has one edge and no edge below it: its b is what it reaches."""
    ends = (edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionAll(edges.select("b", F.lit(0), F.lit(1)))
            .groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
    return ends.where("up > 1 OR up > 0 AND down > 0").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(id, root): every node of ``edges`` (columns a, b) except the roots, and the smallest node it reaches.

    Edges with a null end are left out; loops and repeated edges change nothing.
    """
    spark = edges.sparkSession

    def written(df):
        path = scratch_path(spark, "edges")
        df.write.parquet(path)
        return path, spark.read.parquet(path)

    path, current = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _only_stars(current):
        last = path
        path, current = written(_small_star(_large_star(current)))
        release_path(spark, last)
    return current.select(F.col("a").alias("id"), F.col("b").alias("root"))
