"""Every query runs; those with SQL agree with it as multisets of rows."""

import pytest

from corefold.operators import keys as K
from corefold.plans import queries as Q
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    if name in Q.ORACLE_SQL:
        assert oracle.compare(spark, SF, Q.QUERIES[name], Q.ORACLE_SQL[name]) == ""
    else:
        rows = Q.QUERIES[name](spark, SF).collect()
        assert rows


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(Q.QUERIES) <= set(entry.queries())


def test_no_cartesian_products(spark):
    for name in ("candidates", "top_25_by_evidence", "features_44"):
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_plans_stay_small(spark):
    """Nothing moves the whole expression of the keys into another node; the driver's memory grows with its plans."""
    for name in ("candidates_train", "pass_contribution", "features_44", "feature_statistics"):
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan()
        spark.conf.set("spark.sql.maxPlanStringLength", 200_000_000)  # the views have set less
        assert max(map(len, plan.toString().splitlines())) < 50_000, name
    spark.conf.unset("spark.sql.maxPlanStringLength")


def test_records_without_keys_have_no_postings(spark):
    rows = spark.createDataFrame([("a", 1, ["k", None, "k"]), ("b", 2, []), ("c", 3, None)], "entity_id string, pos long, keys array<string>")
    assert sorted(map(tuple, K.postings(rows).collect()), key=str) == [("a", 1, 0, "k"), ("a", 1, 1, None), ("a", 1, 2, "k")]
