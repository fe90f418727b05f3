"""From probabilities to an ordered set of zero, one or many matches per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBER_PENALTY = 0.08
RESCUE_LEAST, RESCUE_MARGIN = 0.70, 0.25


def deduped(scored: DataFrame) -> DataFrame:
    """One row per pair with its largest probability; other columns are those of such a row."""
    more = [c for c in scored.columns if c not in ("s1_id", "noisy_id", "prob")]
    best = scored.groupBy("s1_id", "noisy_id").agg(F.max(F.struct("prob", *more)).alias("b"))
    return best.select("s1_id", "noisy_id", "b.*")


def chosen(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs at or over the threshold."""
    return deduped(scored).where(F.col("prob") >= threshold)


def chosen_with_rules(scored: DataFrame, threshold: float, conflict: str = "addr_num_exact_mismatch") -> DataFrame:
    """A pair whose street numbers conflict needs ``NUMBER_PENALTY`` more. A record without a pair gets its best one if that is likely, clearly ahead and without conflict."""
    order = Window.partitionBy("s1_id").orderBy(F.col("prob").desc(), "noisy_id")
    whole = Window.partitionBy("s1_id")
    clash = F.coalesce(F.col(conflict), F.lit(0)) == 1
    marked = deduped(scored).withColumn("__keep", F.col("prob") >= F.when(clash, F.round(F.lit(threshold) + NUMBER_PENALTY, 9)).otherwise(F.lit(threshold)))
    ranked = marked.withColumns({"__rank": F.row_number().over(order), "__next": F.lead("prob", 1, 0.0).over(order), "__any": F.max(F.col("__keep").cast("int")).over(whole)})
    rescue = (F.col("__any") == 0) & (F.col("__rank") == 1) & (F.col("prob") >= RESCUE_LEAST) & (F.round(F.col("prob") - F.col("__next"), 9) >= RESCUE_MARGIN) & ~clash
    return ranked.where(F.col("__keep") | rescue).drop("__keep", "__rank", "__next", "__any")


def ordered(s1: DataFrame, picked: DataFrame, out: str = "matched_entity_ids") -> DataFrame:
    """Every s1 row with its matches, likeliest first, ties by id; an empty array where it has none."""
    listed = picked.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("prob")).alias("p"), "noisy_id"))), lambda x: x["noisy_id"]).alias(out))
    return s1.select(F.col("entity_id").alias("s1_id"), *[c for c in ("pos",) if c in s1.columns]).join(listed, "s1_id", "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def formatted(matches: DataFrame, ids: str = "matched_entity_ids", separator: str = ", ") -> DataFrame:
    return matches.withColumn(ids, F.array_join(ids, separator))
