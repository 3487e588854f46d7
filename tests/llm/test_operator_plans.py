"""Properties that the plans of all registered operators share."""

import pytest

from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
NATIVE = ("op10_",)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_join_and_native_operators_without_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name.startswith(NATIVE):
        assert not any(word in plan for word in ("Python", "InPandas", "InArrow"))


def test_one_worker_encodes_and_decodes(spark):
    """Short texts go to Python once; only the few long ones are decoded in a step of their own."""
    plan = queries.op7_bpe(spark, SF)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Union", 1)
    assert "ArrowEvalPython" not in above  # nothing is decoded after both kinds of texts came together
    assert below.split("FlatMapGroupsInPandas")[0].count("ArrowEvalPython") == 2  # short texts, and the long ones' ids
