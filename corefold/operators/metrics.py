"""Macro and micro precision, recall and F0.5 over records, threshold sweeps and cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = [k / 100 for k in range(5, 96)]


def counts(s1: DataFrame, truth: DataFrame, picked: DataFrame) -> DataFrame:
    """``s1_id, n_true, n_pred, tp`` of every record."""
    t = truth.select("s1_id", "noisy_id").distinct().withColumn("t", F.lit(1))
    p = picked.select("s1_id", "noisy_id").distinct().withColumn("p", F.lit(1))
    both = t.join(p, ["s1_id", "noisy_id"], "full")
    grouped = both.groupBy("s1_id").agg(F.count("t").alias("n_true"), F.count("p").alias("n_pred"), F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"))
    zero = F.lit(0).cast("bigint")
    return s1.select(F.col("entity_id").alias("s1_id")).join(grouped, "s1_id", "left").select("s1_id", *[F.coalesce(c, zero).alias(c) for c in ("n_true", "n_pred", "tp")])


def f_beta(p: Column, r: Column, beta2: float = 0.25) -> Column:
    return F.when(beta2 * p + r > 0, (1 + beta2) * p * r / (beta2 * p + r)).otherwise(0.0)


def scores(counted: DataFrame, singleton_credit: bool = True) -> DataFrame:
    """Add ``precision, recall, f05``. A record without true matches scores 1 for predicting none (if given credit), else 0."""
    empty = F.when((F.col("n_pred") == 0) & F.lit(singleton_credit), 1.0).otherwise(0.0)
    p = F.when(F.col("n_true") == 0, empty).when(F.col("n_pred") == 0, 0.0).otherwise(F.col("tp") / F.col("n_pred"))
    r = F.when(F.col("n_true") == 0, empty).when(F.col("n_pred") == 0, 0.0).otherwise(F.col("tp") / F.col("n_true"))
    out = counted.withColumns({"precision": p, "recall": r})
    return out.withColumn("f05", F.when(F.col("n_true") == 0, F.col("precision")).when(F.col("tp") == 0, 0.0).otherwise(f_beta(F.col("precision"), F.col("recall"))))


def summary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Macro averages, global sums with their P/R/F0.5, and error rates of singletons, single and multiple matches."""
    tp, pred, true = F.sum("tp"), F.sum("n_pred"), F.sum("n_true")
    p, r = F.when(pred > 0, tp / pred).otherwise(0.0), F.when(true > 0, tp / true).otherwise(0.0)
    rate = lambda wrong, of: F.when(F.count_if(of) > 0, F.count_if(of & wrong) / F.count_if(of)).otherwise(0.0)
    inexact = (F.col("tp") != F.col("n_true")) | (F.col("tp") != F.col("n_pred"))
    rounded = lambda c, n: F.round(c, 6).alias(n)
    return scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n_entities"), rounded(F.avg("precision"), "macro_precision"), rounded(F.avg("recall"), "macro_recall"), rounded(F.avg("f05"), "macro_f05"),
        tp.alias("tp"), (pred - tp).alias("fp"), (true - tp).alias("fn"), rounded(p, "micro_precision"), rounded(r, "micro_recall"), rounded(f_beta(p, r), "micro_f05"),
        rounded(rate(F.col("n_pred") > 0, F.col("n_true") == 0), "singleton_fp_rate"), rounded(rate(inexact, F.col("n_true") == 1), "single_error_rate"), rounded(rate(inexact, F.col("n_true") > 1), "multi_error_rate"),
    )


def cohorts(scored: DataFrame) -> DataFrame:
    """Exact, partial and empty predictions of records with 0, 1 and more true matches."""
    cohort = F.when(F.col("n_true") == 0, "0").when(F.col("n_true") == 1, "1").otherwise("2+")
    exact = (F.col("tp") == F.col("n_true")) & (F.col("tp") == F.col("n_pred"))
    none = (F.col("n_pred") == 0) & (F.col("n_true") > 0)
    return scored.groupBy(cohort.alias("cohort")).agg(F.count("*").alias("n_entities"), F.count_if(exact).alias("exact"), F.count_if(~exact & ~none).alias("partial"), F.count_if(none).alias("empty"), F.round(F.avg("f05"), 6).alias("macro_f05"))


def sweep(s1: DataFrame, truth: DataFrame, scored: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """``threshold`` and macro and micro measures at each point of the grid.

    One pass: a pair counts at all thresholds up to its probability, so each record's counts are summed per step of the grid and
    accumulated from the top, instead of once per threshold. Records are grouped by their counts before they are repeated.
    """
    steps = F.array(*[F.lit(round(t, 2)) for t in grid])
    t = truth.select("s1_id", "noisy_id").distinct().withColumn("t", F.lit(1))
    pairs = scored.groupBy("s1_id", "noisy_id").agg(F.max("prob").alias("prob")).join(t, ["s1_id", "noisy_id"], "left")
    level = F.size(F.filter(steps, lambda x: x <= F.col("prob")))  # how many thresholds take the pair
    placed = pairs.select("s1_id", level.alias("level"), F.coalesce("t", F.lit(0)).alias("t")).where("level > 0")
    per = placed.groupBy("s1_id", "level").agg(F.count("*").alias("pred"), F.sum("t").alias("tp"))
    steps_of = per.groupBy("s1_id").agg(F.collect_list(F.struct("level", "pred", "tp")).alias("steps"))
    n_true = t.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    records = s1.select(F.col("entity_id").alias("s1_id")).join(n_true, "s1_id", "left").join(steps_of, "s1_id", "left")
    same = records.select(F.coalesce("n_true", F.lit(0)).alias("n_true"), F.array_sort(F.coalesce("steps", F.array().cast("array<struct<level:int,pred:bigint,tp:bigint>>"))).alias("steps")).groupBy("n_true", "steps").agg(F.count("*").alias("w"))
    grid_rows = same.select("n_true", "w", "steps", F.posexplode(steps).alias("k", "threshold"))
    over = lambda f: F.aggregate(F.filter("steps", lambda s: s["level"] > F.col("k")), F.lit(0).cast("bigint"), lambda acc, s: acc + s[f])
    marked = scores(grid_rows.withColumns({"n_pred": over("pred"), "tp": over("tp")}))
    w = F.col("w")
    tp, pred, true = F.sum(w * F.col("tp")), F.sum(w * F.col("n_pred")), F.sum(w * F.col("n_true"))
    p, r = F.when(pred > 0, tp / pred).otherwise(0.0), F.when(true > 0, tp / true).otherwise(0.0)
    mean = lambda c: F.round(F.sum(w * F.col(c)) / F.sum(w), 6)
    return marked.groupBy("threshold").agg(
        mean("precision").alias("macro_precision"), mean("recall").alias("macro_recall"), mean("f05").alias("macro_f05"), tp.alias("tp"), (pred - tp).alias("fp"), (true - tp).alias("fn"),
        F.round(p, 6).alias("micro_precision"), F.round(r, 6).alias("micro_recall"), F.round(f_beta(p, r), 6).alias("micro_f05"),
    )


def best_threshold(swept: DataFrame, measure: str = "macro_f05") -> float:
    """The smallest threshold of those with the best measure."""
    return swept.orderBy(F.col(measure).desc(), "threshold").first()["threshold"]


def pair_sweep(scored: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """``threshold, tp, fp, fn, tn``, F0.5 and F1 of labelled pairs: sums per step of the grid, accumulated over the grid's few rows."""
    steps = F.array(*[F.lit(round(t, 2)) for t in grid])
    level = F.size(F.filter(steps, lambda x: x <= F.col("prob")))
    per = scored.groupBy(level.alias("level")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    levels = scored.sparkSession.range(0, len(grid) + 1).select(F.col("id").cast("int").alias("level")).join(per, "level", "left").na.fill(0, ["pos", "neg"])
    down = Window.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = levels.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down), "all_pos": F.sum("pos").over(every), "all_neg": F.sum("neg").over(every)}).where("level > 0")
    p, r = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0), F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos")).otherwise(0.0)
    return summed.select(
        F.get(steps, F.col("level") - 1).alias("threshold"), "tp", "fp", (F.col("all_pos") - F.col("tp")).alias("fn"), (F.col("all_neg") - F.col("fp")).alias("tn"),
        F.round(f_beta(p, r), 6).alias("f05"), F.round(f_beta(p, r, 1.0), 6).alias("f1"),
    )


def compared(runs: DataFrame, order: str = "experiment") -> DataFrame:
    """A progression log: each run's measures with their change from the run before. One row per run."""
    w = Window.orderBy(order)
    return runs.withColumns({f"{c}_delta": F.round(F.col(c) - F.lag(c).over(w), 6) for c in ("macro_f05", "macro_precision", "macro_recall")})
