"""Sources, models, the command line and the stream, end to end on small tables."""

import pytest
from pyspark.sql import functions as F

from corefold.operators import models as ML
from corefold.plans import pipeline as PL
from corefold.plans.entities import table
from corefold.sources import tables as IO
from corefold.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("data")
    columns = ["entity_id", "business_name", "business_address", "country"]
    for kind, low, high in (("train", 0, 140), ("test", 140, 200)):
        for i, name in ((1, "s1"), (2, "s2"), (3, "s3")):
            rows = table(spark, SF, name).where(f"pos % 1000000000000 >= {low} AND pos % 1000000000000 < {high}").orderBy("pos").select(*columns).toPandas()
            rows.to_csv(f"{out}/{kind}_source{i}.tsv", sep="\t", index=False)
    truth = table(spark, SF, "truth").groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("noisy_id")), ",").alias("matched_entity_ids"))
    all_ = table(spark, SF, "s1").select(F.col("entity_id").alias("source1_entity_id")).join(truth.withColumnRenamed("s1_id", "source1_entity_id"), "source1_entity_id", "left")
    all_.toPandas().to_csv(f"{out}/train_ground_truth.tsv", sep="\t", index=False)
    return out


def test_reading(spark, folder, tmp_path):
    literal, parsed = (IO.read_tsv(spark, f"{folder}/train_source3.tsv", na_mode=m) for m in ("literal", "pandas_default"))
    assert literal.where("business_name = 'NULL'").count() > 0 and parsed.where("business_name = 'NULL'").count() == 0
    assert literal.where("business_address IS NULL").count() == 0 < parsed.where("business_address IS NULL").count()
    placed = IO.with_positions(literal.repartition(3)).select("pos").collect()
    assert sorted(r.pos for r in placed) == list(range(literal.count()))
    with pytest.raises(ValueError):
        IO.read_tsv(spark, "x", na_mode="other")
    pairs = IO.truth_pairs(IO.read_tsv(spark, f"{folder}/train_ground_truth.tsv", IO.TRUTH))
    assert pairs.exceptAll(table(spark, SF, "truth").select("s1_id", "noisy_id", "source")).isEmpty()
    assert IO.read_tsv(spark, f"{folder}/train_source1.tsv", columns=["entity_id"]).columns == ["entity_id"]
    calls = []
    compute = lambda df: calls.append(1) or df.select("entity_id")
    for source in (literal, literal, literal.limit(3)):
        IO.cached(spark, str(tmp_path / "cache"), [source], compute)
    assert len(calls) == 2
    rows = spark.createDataFrame([("S1-1", " S2-1 , ,S3-2"), ("S1-2", None)], "s1_id string, matched_entity_ids string")
    assert [r.matched_entity_ids for r in IO.reformatted(rows).collect()] == ["S2-1,S3-2", ""]
    IO.write_metrics(rows.limit(1), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 1 and "S1-1" in IO.metrics_json(rows)
    IO.write_sample(rows, str(tmp_path / "s"), "s1_id", 1)
    assert spark.read.text(str(tmp_path / "s")).count() == 2
    assert IO.head(rows, 1, "s1_id").first().s1_id == "S1-1"


def test_command_line(spark, folder, tmp_path):
    args = ["--data", str(folder), "--model", str(tmp_path / "model"), "--output", str(tmp_path / "out"), "--quick"]
    assert PL.main(["full", *args], spark) == 0
    lines = [r.value for r in spark.read.text(str(tmp_path / "out/matching_results.tsv")).collect()]
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and len(lines) == 61
    assert [x.split("\t")[0] for x in lines[1:]] == [f"S1-{i}" for i in range(140, 200)]
    found = {x.split("\t")[0]: set(x.split("\t")[1].split(",")) - {""} for x in lines[1:]}
    true = {}
    for r in table(spark, SF, "truth").collect():
        true.setdefault(r.s1_id, set()).add(r.noisy_id)
    hits = sum(len(found[s] & true.get(s, set())) for s in found)
    assert hits / max(1, sum(map(len, found.values()))) > 0.4 and hits > 40
    assert PL.main(["validate", *args, "--no-check-ids"], spark) == 0
    broken = [lines[0], *lines[2:]]
    spark.createDataFrame([("\n".join(broken),)], "value string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "out/matching_results.tsv"))
    assert PL.main(["validate", *args], spark) == 1


def test_models(spark, tmp_path):
    from corefold.plans import queries as Q

    pairs = Q.training_set(spark, SF, 60, 10)
    s1, pool, truth = (table(spark, SF, t) for t in ("s1", "pool", "truth"))
    from corefold.operators import features as FE

    rows = FE.features(pairs.select("s1_id", "noisy_id", "label", "is_validation"), s1, pool, "train", ("label", "is_validation"))
    rows.write.parquet(str(tmp_path / "rows"))
    truth.write.parquet(str(tmp_path / "truth"))
    rows, truth = (spark.read.parquet(str(tmp_path / t)) for t in ("rows", "truth"))
    train, held = rows.where("NOT is_validation"), rows.where("is_validation")
    ids = held.select(F.col("s1_id").alias("entity_id")).distinct()
    mine = truth.join(ids.withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi")
    table_ = ML.compare(train, held, ids, mine, ("logistic", "forest"), quick=True).collect()
    assert table_[0].macro_f05 >= table_[-1].macro_f05 > 0.5 and all(r.roc_auc > 0.8 for r in table_)
    log, _ = ML.experiments(train, held, ids, mine, quick=True)
    assert [r.experiment for r in log.orderBy("experiment").collect()] == [0, 1, 2, 3]
    model = ML.train(train, "logistic", quick=True)
    ranked = ML.coefficients(model)
    assert len(ranked) == 44 and ranked[0][1] >= ranked[-1][1]
    with pytest.raises(ValueError):
        ML.pipeline("extra_trees")


def test_stream_equals_batch(spark, tmp_path):
    from corefold.plans import queries as Q

    s1 = table(spark, SF, "s1").drop("pos")
    s1.repartition(4).write.parquet(str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema(s1.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = incremental.match_stream(stream, incremental.blocked_pool(table(spark, SF, "pool"), Q.CAP), 25, lambda df, n: got.extend(df.select("s1_id", "noisy_id", "rank").collect()), str(tmp_path / "check"))
    q.awaitTermination(120)
    want = Q.top_25_by_evidence(spark, SF).select("s1_id", "noisy_id", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_no_join_broadcasts_a_side_by_its_guessed_size(spark):
    from corefold.plans import entities as E
    from corefold.plans import queries as Q

    before = {k: spark.conf.get(k, None) for k in (E.STATIC, E.MEASURED)}
    try:
        for k in before:
            spark.conf.unset(k)
        most = spark.conf.get(E.STATIC)
        for name in ("recall_at_k", "pass_contribution", "features_serve", "feature_statistics"):
            plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name
        assert spark.conf.get(E.MEASURED) == most and spark.conf.get(E.STATIC) == "-1"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
