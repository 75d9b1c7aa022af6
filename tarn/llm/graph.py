"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the
    smallest node reachable.

    Each step is a partial aggregation and a join by key that Spark can
    split; every round is a written table. Nothing reaches the driver but
    a count and a checksum.
    """
    step = scratch.save(_oriented(edges, "a", "b"), f"{label}0")
    seen, number = None, 0
    while True:
        large = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (large.where("v > u").join(least, F.col("u") == F.col("w"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))
        number += 1
        step = scratch.save(_oriented(small, "u", "v"), f"{label}{number}")
        scratch.drop(f"{label}{number - 1}")
        now = step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = step.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(step.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    return (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
