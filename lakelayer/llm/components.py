"""Connected components of an edge table by alternating large-star and small-star steps.

Each step points every node at the least node it knows. A hub's edges are grouped with
map-side combine for the minimum and joined back, so they are never gathered in a task.
Steps are written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _least(edges: DataFrame) -> DataFrame:
    """u, m: each node with the least of itself and its neighbours, edges seen from u."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = down.join(_least(down), "u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        near.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of an edge but the labels
    themselves. ``edges`` has columns u and v of one integer type."""
    spark = edges.sparkSession
    state = None
    links = edges.where("u != v")
    while True:
        for star in (_large_star, _small_star):
            path = scratch_path(spark, "star")
            star(links).where("u != v").distinct().write.parquet(path)
            links = spark.read.parquet(path)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now
