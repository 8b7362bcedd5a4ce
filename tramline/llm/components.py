"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import scratch_dir

STAR_SCHEMA = "a long, b long"


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that has an edge to a lesser one of its component, and its least node.

    Alternates large and small stars until nothing changes, in about log n
    rounds. Each round is a written table, so that lineage stays short and a
    lost executor costs one round at most. Minima are combined before the
    shuffle, and joins may split the rows of one node.
    """
    spark = edges.sparkSession
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        path = scratch_dir(spark, "stars")
        edges.write.parquet(path)
        edges = spark.read.schema(STAR_SCHEMA).parquet(path)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        before = state
        edges = _small_star(_large_star(edges).distinct()).distinct()
