"""Connected components by alternating large-star and small-star steps on edges between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastword.llm import frames


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour (larger ones, or smaller ones and itself) to the least of its node."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = sides.join(least, "u")
    if large:
        return joined.where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node of `edges` (a, b).

    Each step is written to the shared folder; the number of steps grows with the logarithm of the
    longest chain.
    """
    now = frames.written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = _state(now)
        if state == before or not state[0]:
            break
        before = state
        now = frames.written(_star(_star(now, True), False), "edges")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v"), F.col("v"))).groupBy("node").agg(F.min("component").alias("component"))
