"""Connected components of a distributed edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; component is the smallest node that can be reached.

    Minima are aggregated before they are joined back, so a node with very many links is no single task's work; each round is
    written to the shared folder, and the one before it is removed. Self links are ignored.
    """
    spark = edges.sparkSession
    now, path = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        new, new_path = scratch.table(_small_star(_large_star(now)), "links")
        was, state = state, _state(new)
        scratch.delete(spark, path)
        now, path = new, new_path
        if state == was:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour (or itself)."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(low.withColumnRenamed("a", "u"), F.col("b") == F.col("u"), "left")
    return joined.select("a", F.coalesce("low", "b").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(low.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
    return joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b"))).distinct()
