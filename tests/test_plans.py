"""Properties of the plans that matter on large tables."""

import pytest

from tidemark.plans import registry

SF_DIR = "/root/testdata/sf0.001"
PYTHON = ("bootstrap", "chi_square", "mann_whitney")  # generators and tail probabilities
STREAMS = ("stream_",)


def plan_of(spark, name):
    return registry.run(name, spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith(STREAMS)))
def test_no_cross_join_and_no_python_in_the_main_path(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if not name.startswith(PYTHON):
        assert not any(word in plan for word in ("Python", "InPandas", "InArrow"))


@pytest.mark.parametrize("name", ["feed_user_daily", "daily_summary", "feed_week", "alert_feed_buckets"])
def test_time_range_is_pushed_down(spark, name):
    assert "GreaterThanOrEqual(ts,2024-01-" in plan_of(spark, name)


def test_retention_shuffles_one_row_per_user(spark):
    plan = plan_of(spark, "app_retention")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_bit_or" in plan and "Join" not in plan


def test_merge_of_feed_and_messages_is_one_exchange(spark):
    plan = plan_of(spark, "action_comb")
    assert "partial_max(likes" in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "top_campaigns_ctr")


def test_students_meet_their_totals_without_another_shuffle(spark):
    """Three tables are shuffled by student once; the fourth exchange is by group."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, "funnel_metrics")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 5  # the list of students is made distinct first
