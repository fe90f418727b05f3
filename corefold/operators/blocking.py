"""Candidate generation: prune hot keys, join on keys, cap deterministically."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import keys as K

SERVE_CAP = 300  # a key stays if it has fewer postings, repeats counted
TRAIN_CAP = 500  # a key stays if it has at most so many


def key_sizes(pool: DataFrame) -> DataFrame:
    """``(block_key, bucket_len)`` of pool postings, repeats counted."""
    return pool.groupBy("block_key").agg(F.count("*").alias("bucket_len"))


def active_keys(pool: DataFrame, cap: int = SERVE_CAP, variant: str = "serve") -> DataFrame:
    """Keys that survive pruning. The count is aggregated before it is shuffled, so that hot keys cost no more than others."""
    sizes = key_sizes(pool)
    return sizes.where(F.col("bucket_len") < cap) if variant == "serve" else sizes.where(F.col("bucket_len") <= cap)


def hits(queries: DataFrame, pool: DataFrame, active: DataFrame) -> DataFrame:
    """All (query key occurrence, posting) meetings on active keys: ``s1_id, noisy_id, s1_key_pos, noisy_pos, noisy_key_pos, block_key, bucket_len``.

    Pruning comes first: a key that stays has a bounded bucket, so the join's output is at most the cap times the query keys.
    """
    q = queries.select(F.col("entity_id").alias("s1_id"), F.col("key_pos").alias("s1_key_pos"), "block_key")
    p = pool.select(F.col("entity_id").alias("noisy_id"), F.col("pos").alias("noisy_pos"), F.col("key_pos").alias("noisy_key_pos"), "block_key")
    return p.join(active, "block_key").join(q, "block_key")


def candidates(met: DataFrame) -> DataFrame:
    """Distinct pairs."""
    return met.select("s1_id", "noisy_id").distinct()


def _first_meetings(met: DataFrame) -> DataFrame:
    """Each pair's first meeting in the order of query keys, then postings."""
    return met.groupBy("s1_id", "noisy_id").agg(F.min(F.struct("s1_key_pos", "noisy_pos", "noisy_key_pos")).alias("first")).select("s1_id", "noisy_id", "first.*")


def _stop_after(first: DataFrame, order: str, enough: int) -> DataFrame:
    """Keep pairs whose bucket was read: buckets are read in ``order`` until a query has ``enough`` candidates."""
    before = Window.partitionBy("s1_id").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    return first.withColumn("__before", F.count("*").over(before)).where(F.col("__before") < enough).drop("__before")


def legacy_candidates(met: DataFrame, per_bucket: int = 8, enough: int = 15) -> DataFrame:
    """At most ``per_bucket`` postings of a bucket, in pool order; no more buckets once a query has ``enough``."""
    bucket = Window.partitionBy("s1_id", "s1_key_pos").orderBy("noisy_pos", "noisy_key_pos")
    sliced = met.withColumn("__rank", F.row_number().over(bucket)).where(F.col("__rank") <= per_bucket)
    return _stop_after(_first_meetings(sliced), "s1_key_pos", enough).select("s1_id", "noisy_id")


def early_stop_candidates(met: DataFrame, enough: int = 450) -> DataFrame:
    """Buckets of a query in the order of key weight (largest first), size and key, until it has ``enough`` candidates.

    The order replaces one that depends on the hashes of a process.
    """
    order = Window.partitionBy("s1_id").orderBy(F.col("weight").desc(), "bucket_len", "block_key")
    placed = met.withColumn("weight", K.key_weight(F.col("block_key"))).withColumn("bucket_pos", F.dense_rank().over(order))
    first = placed.groupBy("s1_id", "noisy_id").agg(F.min("bucket_pos").alias("bucket_pos"))
    return _stop_after(first, "bucket_pos", enough).select("s1_id", "noisy_id")


def first_k(met: DataFrame, k: int | None) -> DataFrame:
    """The first k distinct candidates of each query in the order of keys, then postings; all if k is None."""
    first = _first_meetings(met)
    if k is None:
        return first.select("s1_id", "noisy_id")
    order = Window.partitionBy("s1_id").orderBy("s1_key_pos", "noisy_pos", "noisy_key_pos", "noisy_id")
    return first.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= k).select("s1_id", "noisy_id")


def k_sensitivity(met: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """``(k, captured, pairs)`` for each k: one ranking, then conditional counts. ``truth`` is ``(s1_id, noisy_id)``."""
    order = Window.partitionBy("s1_id").orderBy("s1_key_pos", "noisy_pos", "noisy_key_pos", "noisy_id")
    ranked = _first_meetings(met).withColumn("rank", F.row_number().over(order))
    marked = ranked.join(truth.select("s1_id", "noisy_id", F.lit(1).alias("hit")), ["s1_id", "noisy_id"], "left")
    grid = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    return marked.select("*", grid).where("rank <= k").groupBy("k").agg(F.coalesce(F.sum("hit"), F.lit(0)).cast("long").alias("captured"), F.count("*").alias("pairs"))


def completed(s1: DataFrame, pairs: DataFrame, out: str = "candidate_ids") -> DataFrame:
    """Every s1 row with its sorted candidates; an empty array where it has none."""
    grouped = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("noisy_id")).alias(out))
    return s1.select(F.col("entity_id").alias("s1_id")).join(grouped, "s1_id", "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def lost(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    return truth.join(pairs, ["s1_id", "noisy_id"], "left_anti")


def captured(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    return truth.join(pairs, ["s1_id", "noisy_id"], "left_semi")


def attributes(ids: DataFrame, records: DataFrame, key: str = "entity_id") -> DataFrame:
    """The records of the given ids."""
    return records.join(ids.select(key).distinct(), key, "left_semi")
