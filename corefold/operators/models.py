"""Classifiers over pair features on Spark ML: training, scoring, comparison, experiments."""

from __future__ import annotations

import json
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decision, metrics
from .features import BASE_40, NAMES

#: Extremely randomised trees have no Spark ML counterpart; the nearest is a forest on all rows, which is offered under its own name.
KINDS = ("logistic", "logistic_balanced", "gbt", "gbt_champion", "forest", "forest_all_rows")


def balanced(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Weights that give both classes the same total."""
    n = df.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    pos, neg = n.p or 0, n.n - (n.p or 0)
    return df.withColumn(out, F.when(F.col(label) == 1, n.n / (2 * max(pos, 1))).otherwise(n.n / (2 * max(neg, 1))))


def pipeline(kind: str, names: list[str] = NAMES, n_rows: int | None = None, seed: int = 42, quick: bool = False) -> Pipeline:
    """``quick`` shortens boosting and forests for tests."""
    if kind not in KINDS:
        raise ValueError(kind)
    stages = [VectorAssembler(inputCols=names, outputCol="raw", handleInvalid="keep")]
    common = {"featuresCol": "raw", "labelCol": "label"}
    if kind.startswith("logistic"):
        stages.append(StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True))
        model = LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=50 if quick else 1000, regParam=1.0 / max(n_rows or 1, 1), standardization=False)
    elif kind == "gbt":
        model = GBTClassifier(**common, maxIter=3 if quick else 150, stepSize=0.08, maxDepth=5, minInstancesPerNode=20, seed=seed)
    elif kind == "gbt_champion":
        model = GBTClassifier(**common, maxIter=3 if quick else 250, stepSize=0.05, maxDepth=6, minInstancesPerNode=15, seed=seed)
    else:
        rate = 1.0
        model = RandomForestClassifier(**common, numTrees=10 if quick else 100, maxDepth=16, minInstancesPerNode=10, subsamplingRate=rate, bootstrap=kind == "forest", seed=seed)
    if kind != "logistic":
        model.setWeightCol("weight")
    return Pipeline(stages=[*stages, model])


def train(pairs: DataFrame, kind: str = "gbt_champion", names: list[str] = NAMES, quick: bool = False) -> PipelineModel:
    df = balanced(pairs) if kind != "logistic" else pairs
    return pipeline(kind, names, pairs.count() if kind.startswith("logistic") else None, quick=quick).fit(df)


def score(model: PipelineModel, features: DataFrame, out: str = "prob") -> DataFrame:
    """Add the probability of a match."""
    scored = model.transform(features).withColumn(out, vector_to_array("probability")[1])
    return scored.drop("raw", "scaled", "rawPrediction", "probability", "prediction")


def areas(scored: DataFrame) -> dict[str, float]:
    """Areas under the ROC and the precision-recall curve (the latter by trapezoids)."""
    return {k: BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="label", metricName=m).evaluate(scored) for k, m in (("roc_auc", "areaUnderROC"), ("average_precision", "areaUnderPR"))}


def coefficients(model: PipelineModel, names: list[str] = NAMES) -> list[tuple[str, float]]:
    """Features of a logistic model from the largest to the smallest coefficient."""
    return sorted(zip(names, model.stages[-1].coefficients.toArray().tolist()), key=lambda x: (-x[1], x[0]))


def timed(df: DataFrame) -> float:
    """Seconds to compute a DataFrame in full."""
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def evaluate(scored: DataFrame, s1: DataFrame, truth: DataFrame) -> dict:
    """The best threshold by macro F0.5 and the measures there."""
    swept = metrics.sweep(s1, truth, scored).cache()
    best = metrics.best_threshold(swept)
    row = swept.where(F.col("threshold") == best).first().asDict()
    swept.unpersist()
    return row


def compare(train_pairs: DataFrame, validation: DataFrame, s1: DataFrame, truth: DataFrame, kinds: tuple[str, ...] = KINDS, names: list[str] = NAMES, quick: bool = False) -> DataFrame:
    """One row per kind of model: training time, inference time, areas, best threshold and its measures; best macro F0.5 first."""
    rows = []
    for kind in kinds:
        began = time.perf_counter()
        model = train(train_pairs, kind, names, quick)
        spent = time.perf_counter() - began
        scored = score(model, validation).select("s1_id", "noisy_id", "label", "prob").cache()
        seconds = timed(scored)
        found = evaluate(scored, s1, truth)
        rows.append((kind, spent, seconds, *areas(scored).values(), *[float(found[k]) for k in ("threshold", "macro_f05", "macro_precision", "macro_recall")]))
        scored.unpersist()
    schema = "model string, train_s double, inference_s double, roc_auc double, average_precision double, threshold double, macro_f05 double, macro_precision double, macro_recall double"
    return train_pairs.sparkSession.createDataFrame(rows, schema).orderBy(F.col("macro_f05").desc(), "model")


def experiments(train_pairs: DataFrame, validation: DataFrame, s1: DataFrame, truth: DataFrame, quick: bool = False) -> tuple[DataFrame, PipelineModel]:
    """Experiments 0 to 3: boosting on 40 features; on 44; the champion's settings; those with number penalty and margin rescue."""
    rows, champion, scored = [], None, None
    for number, (kind, names) in enumerate((("gbt", BASE_40), ("gbt", NAMES), ("gbt_champion", NAMES))):
        champion = train(train_pairs, kind, names, quick)
        scored = score(champion, validation).select("s1_id", "noisy_id", "label", "prob", "addr_num_exact_mismatch").cache()
        found = evaluate(scored, s1, truth)
        rows.append((number, kind, len(names), *[float(found[k]) for k in ("threshold", "macro_f05", "macro_precision", "macro_recall")], int(found["fp"]), int(found["fn"])))
    threshold = rows[-1][3]
    picked = decision.chosen_with_rules(scored, threshold)
    last = metrics.summary(metrics.scores(metrics.counts(s1, truth, picked))).first()
    rows.append((3, "gbt_champion with rules", len(NAMES), threshold, last.macro_f05, last.macro_precision, last.macro_recall, int(last.fp), int(last.fn)))
    schema = "experiment int, model string, n_features int, threshold double, macro_f05 double, macro_precision double, macro_recall double, fp long, fn long"
    return metrics.compared(train_pairs.sparkSession.createDataFrame(rows, schema)), champion


def save(model: PipelineModel, path: str, threshold: float, names: list[str] = NAMES, rule: str = "threshold") -> None:
    """The model and, beside it, its features, threshold and decision rule."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    about = json.dumps({"features": names, "threshold": threshold, "rule": rule})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/about").first().value)
