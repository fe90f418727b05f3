"""With Spark's own threshold, no join broadcasts a side whose size is only guessed from the file of ``part``: such sides grow in the driver."""

import pytest

from corefold.plans import queries as Q

SF = "/root/testdata/sf0.001"
THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
NAMES = [
    "candidates_early_stop",
    "candidates_legacy_cap",
    "cohort_quality",
    "decisions",
    "decisions_with_rules",
    "error_causes",
    "features_kernels",
    "first_10_candidates",
    "hard_negative_causes",
    "k_sensitivity",
    "match_quality",
    "match_quality_without_credit",
    "rank_distribution",
    "rank_failure_modes",
    "rank_percentiles",
    "threshold_sweep",
]


@pytest.mark.parametrize("name", NAMES)
def test_no_side_is_broadcast_by_its_guessed_size(spark, name):
    before = {k: spark.conf.get(k, None) for k in THRESHOLDS}
    try:
        for k in THRESHOLDS:
            spark.conf.unset(k)
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan()
        spark.conf.set("spark.sql.maxPlanStringLength", 200_000_000)  # the views have set less
        plan = plan.toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
