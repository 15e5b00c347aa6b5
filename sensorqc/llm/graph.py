"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorqc.llm.base import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is the smallest node of its component.

    Roots appear as nodes too. The loop ends when a round changes nothing; each round is a written table.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = large.filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = materialise(down.unionByName(low.withColumnRenamed("low", "b")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
