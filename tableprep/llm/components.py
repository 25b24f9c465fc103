"""Connected components of a graph of edges, as joins and aggregates that shrink it round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableprep.storage import scratch_dir


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, and survives lost executors."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for each node of ``edges`` (``a``, ``b``; any order).

    Alternates two moves until nothing changes: each node links its larger neighbours to its smallest one, then each
    node links its smaller neighbours to the smallest. The rounds grow with the logarithm of the longest path. Smallest
    neighbours are found by an aggregate that combines before its shuffle, so a node with very many neighbours never
    gathers them in one task."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        keep = least.where("a <> m").select("a", F.col("m").alias("b"))
        wide = large.unionByName(keep).distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        small = wide.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        following = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # a forest of stars changes no more
        if following.exceptAll(edges).isEmpty() and edges.exceptAll(following).isEmpty():
            break
        edges = following
    roots = following.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(following.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
