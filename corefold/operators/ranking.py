"""Evidence scores, ranks and top-K of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from . import keys as K

DIGITS = 9  # scores are rounded, so that the order of a sum makes no ties into ranks


def evidence(met: DataFrame) -> DataFrame:
    """``s1_id, noisy_id, score`` and each pair's first meeting. Every meeting counts: repeated keys multiply."""
    gain = K.key_weight(F.col("block_key")) / F.log2(F.lit(2) + F.col("bucket_len"))
    grouped = met.groupBy("s1_id", "noisy_id").agg(F.round(F.sum(gain), DIGITS).alias("score"), F.min(F.struct("s1_key_pos", "noisy_pos", "noisy_key_pos")).alias("first"), F.count("*").alias("n_meetings"))
    return grouped.select("s1_id", "noisy_id", "score", "n_meetings", "first.*")


def ranked(scored: DataFrame, most: int | None = None) -> DataFrame:
    """Ranks from 1 by score; ties go by first meeting, then id. With ``most``, Spark prunes each group before the shuffle."""
    order = Window.partitionBy("s1_id").orderBy(F.col("score").desc(), "s1_key_pos", "noisy_pos", "noisy_key_pos", "noisy_id")
    out = scored.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.where(F.col("rank") <= most)


def recall_at(ranks: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """``(k, captured, total, recall)`` of truth pairs in the top k."""
    marked = truth.join(ranks.select("s1_id", "noisy_id", "rank"), ["s1_id", "noisy_id"], "left")
    sums = marked.agg(F.count("*").alias("total"), *[F.count_if(F.col("rank") <= k).alias(f"k{k}") for k in ks])
    return sums.select("total", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("captured")) for k in ks])).alias("x")).select(
        "x.k", "x.captured", "total", F.round(F.when(F.col("total") > 0, F.col("x.captured") / F.col("total")).otherwise(0.0), 6).alias("recall")
    )


BANDS = [(10, "1-10"), (25, "11-25"), (50, "26-50"), (75, "51-75"), (100, "76-100")]


def rank_band(rank: Column) -> Column:
    out = F.when(rank.isNull(), "lost")
    for most, name in BANDS:
        out = out.when(rank <= most, name)
    return out.otherwise("100+")


def rank_distribution(ranks: DataFrame, truth: DataFrame) -> DataFrame:
    """``(band, n)`` of the ranks of truth pairs."""
    marked = truth.join(ranks.select("s1_id", "noisy_id", "rank"), ["s1_id", "noisy_id"], "left")
    return marked.groupBy(rank_band(F.col("rank")).alias("band")).agg(F.count("*").alias("n"))


def rank_percentiles(ranks: DataFrame, truth: DataFrame) -> DataFrame:
    """Median, 75th, 90th, 95th, 99th percentile and maximum of captured ranks."""
    found = truth.join(ranks.select("s1_id", "noisy_id", "rank"), ["s1_id", "noisy_id"])
    names = [("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)]
    return found.agg(F.count("*").alias("captured"), *[F.percentile("rank", F.lit(q)).alias(n) for n, q in names], F.max("rank").cast("double").alias("max_rank"))


def _cheap(pairs: DataFrame, weights: tuple[float, ...]) -> Column:
    wn, wa, wnj, waj, wnum, wc, we = weights
    nonempty = lambda a, b: (F.col(a) != "") & (F.col(b) != "")
    sim = lambda a, b: F.when(nonempty(a, b), S.similarity("ratio", F.col(a), F.col(b))).otherwise(0.0)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return (
        wn * sim("s1_name", "noisy_name") + wa * sim("s1_address", "noisy_address")
        + wnj * S.jaccard(F.col("s1_name_tokens"), F.col("noisy_name_tokens")) + waj * S.jaccard(F.col("s1_address_tokens"), F.col("noisy_address_tokens"))
        + wnum * flag(S.overlap(F.col("s1_numbers"), F.col("noisy_numbers"))) + wc * flag(nonempty("s1_country", "noisy_country") & (F.col("s1_country") == F.col("noisy_country")))
        + we * flag(nonempty("s1_name", "noisy_name") & (F.col("s1_name") == F.col("noisy_name")))
    )


def cheap_score(pairs: DataFrame, out: str = "cheap_score") -> DataFrame:
    """Name and address ratio, token overlap, street number, country and exact name, weighted. Columns hold cleaned texts, tokens and numbers of both sides."""
    return pairs.withColumn(out, _cheap(pairs, (0.35, 0.25, 0.15, 0.10, 0.05, 0.05, 0.05)))


def micro_score(pairs: DataFrame, out: str = "micro_score") -> DataFrame:
    """The same with the weights of the micro-benchmark."""
    return pairs.withColumn(out, _cheap(pairs, (0.40, 0.25, 0.15, 0.10, 0.05, 0.05, 0.0)))
