"""Packing documents into padded training batches with optimal length buckets, with DataFrame functions.

Documents are cut into pieces of at most ``budget`` tokens, so that nothing is lost. Dynamic programming over the global histogram of
piece lengths chooses the bucket bounds that need the least padding; a bucket's pieces are padded to its bound, and its
batches hold as many as the token budget allows. The histogram has one row for each length up to the budget, however many documents there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 8192
BUCKETS = 16
ROWS_PER_BLOCK = 50_000


def words(text: str = "text") -> Column:
    """The number of words of a text, which stands for its tokens; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pieces(docs: DataFrame, n_tokens: Column, budget: int = BUDGET, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``piece, first_token, length``: whole budgets, then the rest. A document without tokens is one empty piece."""
    counted = docs.select(*keep, n_tokens.alias("__n"))
    cut = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("__n") / budget) - 1, F.lit(0)).cast("long"))).alias("piece"))
    return cut.select(*keep, "piece", (F.col("piece") * budget).alias("first_token"), F.least(F.col("__n") - F.col("piece") * budget, F.lit(budget)).alias("length"))


def bounds(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> list[int]:
    """Bounds of at most ``buckets`` buckets with the least total padding; lengths ascend. Each bound is a length that occurs.

    cost(i, j), the padding of lengths i < .. <= j in one bucket, satisfies the quadrangle inequality, so the best split points ascend and
    each layer is filled by divide and conquer.
    """
    n = len(lengths)
    if n == 0:
        return []
    length = np.array(lengths, np.float64)
    number = np.concatenate(([0], np.cumsum(np.array(counts, np.float64))))
    total = np.concatenate(([0], np.cumsum(length * np.array(counts, np.float64))))
    best = np.full(n + 1, np.inf)
    best[0] = 0
    splits: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        new, split = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        stack = [(1, n, 0, n - 1)]
        while stack:
            lo, hi, a, b = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            cost = best[i] + length[j - 1] * (number[j] - number[i]) - (total[j] - total[i])
            k = int(np.argmin(cost))
            new[j], split[j] = cost[k], i[k]
            stack += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        best = new
        splits.append(split)
    out, j = [], n
    for split in reversed(splits):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = int(split[j])
    return sorted(out)


def pack(cut: DataFrame, budget: int = BUDGET, buckets: int = BUCKETS, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``pieces`` with ``bucket`` (the padded length), ``batch`` (its number within the bucket) and ``padding``.

    Within a bucket, pieces are in a hashed order. Ranks are exact without one task seeing a bucket: rows are dealt to hashed blocks of
    about ``rows_per_block``, ranked there, and shifted by the sizes of the blocks before. All batches of a bucket but the last are full. Empty pieces are in bucket 0, of one batch.
    """
    histogram = cut.where("length > 0").groupBy("length").count().orderBy("length").collect()
    edges = bounds([r.length for r in histogram], [r["count"] for r in histogram], buckets)
    bucket = F.lit(0).cast("long")
    for edge in reversed(edges):
        bucket = F.when(F.col("length") <= edge, F.lit(edge).cast("long")).otherwise(bucket)
    bucket = F.when(F.col("length") == 0, F.lit(0).cast("long")).otherwise(bucket)
    sizes: dict[int, int] = {}
    for r in histogram:
        edge = next(e for e in edges if r.length <= e)
        sizes[edge] = sizes.get(edge, 0) + r["count"]
    blocks = F.lit(1).cast("long")
    for edge, n in sizes.items():
        blocks = F.when(F.col("bucket") == edge, F.lit(-(-n // rows_per_block)).cast("long")).otherwise(blocks)
    keys = [c for c in cut.columns if c in ("doc_id", "piece", "length")]
    hashed = F.xxhash64(*keys)
    dealt = cut.withColumn("bucket", bucket).withColumn("__h", hashed).withColumn("__block", F.pmod(F.shiftright("__h", 20), blocks))
    before = dealt.groupBy("bucket", "__block").agg(F.count("*").alias("__n"))
    offset = before.withColumn("__before", F.sum("__n").over(Window.partitionBy("bucket").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy("bucket", "__block").orderBy("__h", *[F.asc_nulls_first(k) for k in keys])))
    placed = ranked.join(offset.withColumnsRenamed({"bucket": "__bucket2", "__block": "__block2"}), (F.col("bucket") == F.col("__bucket2")) & (F.col("__block") == F.col("__block2")))
    each = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))), F.lit(1))
    rank = F.col("__rank") - 1 + F.coalesce("__before", F.lit(0))
    batch = F.when(F.col("bucket") == 0, F.lit(0)).otherwise(F.floor(rank / each)).cast("long")
    return placed.select(*cut.columns, "bucket", batch.alias("batch"), (F.col("bucket") - F.col("length")).cast("long").alias("padding"))


def packed(docs: DataFrame, budget: int = BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """Pack documents by their numbers of words: one row per piece."""
    return pack(pieces(docs, words(), budget), budget, buckets)
