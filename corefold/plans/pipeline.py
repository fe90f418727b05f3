"""Training and inference as whole plans, and the command line around them."""

from __future__ import annotations

import argparse
import sys

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking as B
from ..operators import decision as D
from ..operators import features as FE
from ..operators import keys as K
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import pairs as P
from ..operators import ranking as R
from ..operators import validate as V
from ..sources import tables as IO


def candidate_pairs(s1: DataFrame, pool: DataFrame, cap: int = B.SERVE_CAP, most: int | None = None) -> DataFrame:
    """``s1_id, noisy_id`` of all candidates, or of the ``most`` best by evidence."""
    posted = K.postings(K.with_keys(pool))
    met = B.hits(K.postings(K.with_keys(s1)), posted, B.active_keys(posted, cap))
    return B.candidates(met) if most is None else R.ranked(R.evidence(met), most).select("s1_id", "noisy_id")


def match(s1: DataFrame, pool: DataFrame, model: PipelineModel, threshold: float, cap: int = B.SERVE_CAP, most: int | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Every s1 row with its ordered matches. Records carry ``pos``; pairs are dealt out anew before the features, so that records with many candidates don't make slow tasks."""
    pairs = candidate_pairs(s1, pool, cap, most) if candidates is None else candidates
    scored = ML.score(model, FE.features(pairs.repartition("s1_id", "noisy_id"), s1, pool)).select("s1_id", "noisy_id", "prob")
    return D.ordered(s1, D.chosen(scored, threshold))


def fit(s1: DataFrame, pool: DataFrame, truth: DataFrame, kind: str = "gbt_champion", cap: int = B.SERVE_CAP, most_entities: int = 40_000, per_entity: int = 100, variant: str = "serve", quick: bool = False, work: str | None = None) -> tuple[PipelineModel, float, DataFrame]:
    """A model, its best threshold on held-out entities, and the threshold sweep.

    Features are those of serving by default, so that the model sees in use what it was trained on; ``variant="train"`` gives the others.
    They are written below ``work`` if given, which spares each later step their long plan; else they are cached.
    """
    entities = P.split(P.sampled(truth, most_entities)).cache()
    sample = s1.join(entities.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    pairs = P.labelled(entities, truth, candidate_pairs(sample, pool, cap, per_entity), sample, pool)
    features = FE.features(pairs.select("s1_id", "noisy_id", "label"), sample, pool, variant, ("label",)).join(entities, "s1_id")
    if work:
        IO.write_parquet(features, f"{work}/features")
        IO.write_parquet(entities, f"{work}/entities")
        features, entities = (IO.read_parquet(s1.sparkSession, f"{work}/{t}") for t in ("features", "entities"))
    else:
        features = features.cache()
    model = ML.train(features.where("NOT is_validation").drop("is_validation"), kind, quick=quick)
    held = entities.where("is_validation").select(F.col("s1_id").alias("entity_id"))
    scored = ML.score(model, features.where("is_validation")).select("s1_id", "noisy_id", "label", "prob")
    swept = M.sweep(held, truth.join(held.withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi"), scored)
    return model, M.best_threshold(swept), swept


def read_sources(spark: SparkSession, folder: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """s1 and the pool of ``{kind}_source1.tsv`` to ``{kind}_source3.tsv``, numbered in file order."""
    tables = [IO.with_positions(IO.read_tsv(spark, f"{folder}/{kind}_source{i}.tsv", na_mode="literal")) for i in (1, 2, 3)]
    s3 = tables[2].withColumn("pos", F.col("pos") + F.lit(1 << 40))
    return tables[0], IO.pool(tables[1], s3)


def validate(spark: SparkSession, matches: str, s1: DataFrame, pool: DataFrame | None, candidates: str | None = None) -> tuple[bool, DataFrame]:
    """Check written outputs. Whether all is well, and the report."""
    lines = V.read_lines(spark, matches)
    first = lines.first()
    problem = V.header_problem(first.value if first else None)
    if problem:
        return False, spark.createDataFrame([("header", "error", 1, problem)], "rule string, severity string, n long, examples string")
    listed = V.parsed(V.read_lines(spark, candidates), V.CANDIDATE_HEADER) if candidates else None
    report = V.report(V.parsed(lines), s1, pool, listed).cache()
    return V.passed(report), report


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """``corefold full|inference|validate --data DIR --model DIR --output DIR``; exits with 1 if validation fails."""
    ask = argparse.ArgumentParser(prog="corefold", description="Entity resolution: train, match and validate.")
    ask.add_argument("mode", choices=["full", "inference", "validate"])
    ask.add_argument("--data", required=True, help="folder of train_*.tsv and test_*.tsv")
    ask.add_argument("--model", required=True, help="folder of the model")
    ask.add_argument("--output", required=True, help="folder for matching_results.tsv and candidate_pairs.tsv")
    ask.add_argument("--kind", default="gbt_champion", choices=ML.KINDS)
    ask.add_argument("--cap", type=int, default=B.SERVE_CAP)
    ask.add_argument("--check-ids", action=argparse.BooleanOptionalAction, default=True)
    ask.add_argument("--quick", action="store_true")
    given = ask.parse_args(args)
    spark = spark or SparkSession.builder.appName("corefold").getOrCreate()
    if given.mode == "full":
        s1, pool = read_sources(spark, given.data, "train")
        truth = IO.truth_pairs(IO.read_tsv(spark, f"{given.data}/train_ground_truth.tsv", IO.TRUTH))
        model, threshold, _ = fit(s1, pool, truth, given.kind, given.cap, quick=given.quick, work=f"{given.model}/work")
        ML.save(model, given.model, threshold)
    s1, pool = read_sources(spark, given.data, "test")
    if given.mode != "validate":
        model, about = ML.load(spark, given.model)
        pairs = candidate_pairs(s1, pool, given.cap).cache()
        IO.write_submission(match(s1, pool, model, about["threshold"], candidates=pairs), f"{given.output}/matching_results.tsv")
        listed = B.completed(s1, pairs, "candidate_entity_ids").join(s1.select(F.col("entity_id").alias("s1_id"), "pos"), "s1_id")
        IO.write_submission(listed, f"{given.output}/candidate_pairs.tsv", "candidate_entity_ids")
        pairs.unpersist()
    ok, report = validate(spark, f"{given.output}/matching_results.tsv", s1, pool if given.check_ids else None, f"{given.output}/candidate_pairs.tsv")
    report.show(50, False)
    print("PASS" if ok else "FAIL")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
