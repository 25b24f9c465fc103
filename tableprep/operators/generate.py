"""Generated data and the Monte-Carlo estimate of pi."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK_BYTES = 1024


def random_points(spark: SparkSession, samples: int, seed: int | None = None) -> DataFrame:
    """``samples`` points (x, y) drawn evenly from the unit square."""
    y_seed = None if seed is None else seed + 1
    return spark.range(samples).select(F.rand(seed).alias("x"), F.rand(y_seed).alias("y"))


def pi_of_points(points: DataFrame, x: Column, y: Column, radius: Column | float = 1.0) -> DataFrame:
    """(samples, inside, pi): four times the share of points nearer to the origin than ``radius``."""
    radius = radius if isinstance(radius, Column) else F.lit(radius)
    counted = points.agg(
        F.count("*").alias("samples"), F.count_if(x * x + y * y < radius * radius).alias("inside")
    )
    return counted.select("samples", "inside", (F.lit(4.0) * F.col("inside") / F.col("samples")).alias("pi"))


def estimate_pi(spark: SparkSession, samples: int, seed: int | None = None) -> DataFrame:
    return pi_of_points(random_points(spark, samples, seed), F.col("x"), F.col("y"))


def random_block(seed: int | None = None) -> Column:
    """A random block of ``BLOCK_BYTES`` single-byte characters, another one for every row."""
    return F.randstr(BLOCK_BYTES) if seed is None else F.randstr(BLOCK_BYTES, seed)


def generate_bulk(spark: SparkSession, mebibytes: int, seed: int | None = None) -> DataFrame:
    """(id, block): exactly ``mebibytes`` MiB of random payload."""
    return spark.range(mebibytes * 2**20 // BLOCK_BYTES).select("id", random_block(seed).alias("block"))
