"""Labelled pairs for training: positives from the truth, the hardest negatives from the candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

NEGATIVES_PER_POSITIVE = 4


def bucket(column: str, modulus: int = 1000, seed: int = 42):
    """A portable pseudo-random number below ``modulus`` from the digits of an id."""
    number = F.regexp_replace(F.col(column), "[^0-9]", "").cast("bigint")
    return F.pmod((number + seed) * 2654435761, F.lit(modulus))


def sampled(truth: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` entities that have a match: those with the smallest numbers."""
    return truth.select("s1_id").distinct().orderBy(bucket("s1_id", 1_000_003, seed), "s1_id").limit(most)


def split(entities: DataFrame, validation_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``s1_id, is_validation``: by entity, so that no entity is on both sides."""
    return entities.select("s1_id", (bucket("s1_id", 1000, seed) < int(validation_share * 1000)).alias("is_validation"))


def _sides(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    left = s1.select(F.col("entity_id").alias("s1_id"), *[T.clean_input(c).alias(f"s1_{n}") for c, n in (("business_name", "name"), ("business_address", "address"), ("country", "country"))])
    right = pool.select(F.col("entity_id").alias("noisy_id"), *[T.clean_input(c).alias(f"noisy_{n}") for c, n in (("business_name", "name"), ("business_address", "address"), ("country", "country"))])
    return pairs.join(left, "s1_id").join(right, "noisy_id")


def difficulty(pairs: DataFrame) -> DataFrame:
    """Add ``combined`` (0 to 100) and ``is_hard_negative`` from the ratios of lower-case names and addresses; 0 where one is empty."""
    ratio = lambda k: F.when((F.col(f"s1_{k}") != "") & (F.col(f"noisy_{k}") != ""), 100 * S.similarity("ratio", F.lower(f"s1_{k}"), F.lower(f"noisy_{k}"))).otherwise(0.0)
    out = pairs.withColumns({"__n": ratio("name"), "__a": ratio("address")})
    out = out.withColumn("combined", F.round(0.7 * F.greatest("__n", "__a") + 0.15 * (F.col("__n") + F.col("__a")), 9))
    return out.withColumn("is_hard_negative", ((F.col("__n") >= 60) | (F.col("__a") >= 65) | (F.col("combined") >= 55)).cast("int")).drop("__n", "__a")


def labelled(entities: DataFrame, truth: DataFrame, candidates: DataFrame, s1: DataFrame, pool: DataFrame, ratio: int = NEGATIVES_PER_POSITIVE) -> DataFrame:
    """All true matches that exist, and each entity's ``max(2, ratio * matches)`` hardest other candidates; ties go by id."""
    mine = truth.join(entities.select("s1_id"), "s1_id", "left_semi").select("s1_id", "noisy_id").distinct()
    positives = _sides(mine, s1, pool).select("*", F.lit(1).alias("label"), F.lit(0).alias("is_hard_negative"))
    others = candidates.join(entities.select("s1_id"), "s1_id", "left_semi").join(mine, ["s1_id", "noisy_id"], "left_anti")
    scored = difficulty(_sides(others, s1, pool)).join(mine.groupBy("s1_id").agg(F.count("*").alias("__true")), "s1_id")
    order = Window.partitionBy("s1_id").orderBy(F.col("combined").desc(), "noisy_id")
    hardest = scored.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= F.greatest(F.lit(2), ratio * F.col("__true")))
    return positives.unionByName(hardest.select(*[c for c in positives.columns if c != "label"], F.lit(0).alias("label")))


def summary(pairs: DataFrame) -> DataFrame:
    """Class balance and share of hard negatives."""
    return pairs.agg(
        F.count("*").alias("n_pairs"), F.count_if(F.col("label") == 1).alias("n_positive"), F.count_if(F.col("label") == 0).alias("n_negative"),
        F.count_if((F.col("label") == 0) & (F.col("is_hard_negative") == 1)).alias("n_hard"), F.count_distinct("s1_id").alias("n_entities"),
    )
