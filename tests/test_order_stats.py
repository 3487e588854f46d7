"""Exact ranks and quantiles against NumPy, with one range and with many."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.order_stats import (
    quantiles,
    running_counts,
    staged_counts,
    value_counts,
)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


def sample(kind):
    rng = np.random.default_rng(7)
    if kind == "hot":  # one value holds a third of the rows
        return np.concatenate([np.full(1000, 42.0), rng.normal(0, 1e3, 2000)])
    if kind == "ties":
        return rng.integers(0, 9, 2500).astype(float)
    return rng.lognormal(3, 2, 3000)


@pytest.mark.parametrize("kind", ["hot", "ties", "skewed"])
@pytest.mark.parametrize("per_range", [10**6, 100])
def test_quantiles_equal_numpy(spark, kind, per_range):
    values = sample(kind)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    found = quantiles(df, "v", PROBS, values_per_range=per_range).first()[0]
    assert found == pytest.approx(np.quantile(values, PROBS), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("per_range", [10**6, 50])
def test_quantiles_by_group_leave_out_nulls(spark, per_range):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 900, p=[0.8, 0.15, 0.05])})
    frame["v"] = rng.normal(size=900) * frame.g.map({"a": 1, "b": 50, "c": 900})
    frame.loc[::17, "v"] = np.nan
    df = spark.createDataFrame(frame)
    found = {r.g: r.quantiles for r in quantiles(df, "v", PROBS, ["g"], values_per_range=per_range).collect()}
    for g, part in frame.dropna().groupby("g"):
        assert found[g] == pytest.approx(np.quantile(part.v, PROBS), rel=1e-12)


def test_weighted_quantile_equals_repeated_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 4)], "v double, w int")
    found = quantiles(df, "v", [0.5, 0.9], weight="w").first()[0]
    assert found == pytest.approx(np.quantile([1, 1, 1, 2, 10, 10, 10, 10], [0.5, 0.9]))


@pytest.mark.parametrize("per_range", [10**6, 20])
def test_running_counts_cover_every_row(spark, per_range):
    values = np.random.default_rng(1).integers(0, 200, 5000).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = rows(running_counts(staged_counts(df, "v"), values_per_range=per_range), "value")
    seen = 0
    for value, n, before, total in got:
        assert (before, total) == (seen, 5000)
        assert n == (values == value).sum()
        seen += n
    assert seen == 5000


def test_counts_are_combined_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("v"))
    plan = value_counts(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=60), st.floats(0, 1))
def test_any_quantile(spark, values, prob):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = quantiles(df, "v", [prob], values_per_range=7).first()[0][0]
    assert found == pytest.approx(np.quantile(np.array(values, float), prob), rel=1e-9, abs=1e-6)
