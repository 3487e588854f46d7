"""Counter-based draws against plain Python and the distributions they stand for."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import draws, order_stats
from tidemark.operators import abtest


def plain_uniform(key, iteration, seed):
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ x >> 30) * draws.FIRST & mask
        x = (x ^ x >> 27) * draws.SECOND & mask
        return x ^ x >> 31

    start = mix(key + seed * draws.STEP & mask)
    return (mix(start + (iteration + 1) * draws.STEP & mask) >> 11) * 2.0**-53


def test_uniforms_equal_plain():
    keys, iterations = np.array([0, 5, 2**60 - 1]), np.array([0, 3, 999])
    got = draws.uniforms(keys, iterations, 7)
    assert got.tolist() == [[plain_uniform(k, i, 7) for i in iterations.tolist()] for k in keys.tolist()]
    assert (draws.uniforms(keys, iterations[1:], 7) == got[:, 1:]).all()  # any of them can be repeated alone


@pytest.mark.parametrize("lam", [0.3, 1.0, 7.5, 1e4, 1e8])
def test_poisson_table_and_moments(lam):
    first, table = draws.poisson_table(lam)
    for count in {math.floor(lam), math.ceil(lam), max(first, math.floor(lam - math.sqrt(lam)))}:
        if lam < 100:
            want = sum(math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) for k in range(count + 1))
            assert table[count - first] == pytest.approx(want, rel=1e-12)
    got = draws.poisson(np.arange(200), np.full(200, lam), np.arange(500), 1)
    assert got.mean() == pytest.approx(lam, abs=5 * math.sqrt(lam / got.size))
    assert got.var() == pytest.approx(lam, rel=0.03)
    assert abs(np.corrcoef(got[:, 0], got[:, 1])[0, 1]) < 0.3 and got.min() >= 0


def test_a_value_that_is_never_drawn():
    assert (draws.poisson(np.array([3]), np.array([0.0]), np.arange(5), 0) == 0).all()


def frame(spark, n=2000):
    rng = np.random.default_rng(8)
    rows = [("A" if i % 3 else "B", float(v)) for i, v in enumerate(rng.normal(50, 20, n).round(1))]
    return spark.createDataFrame(rows, "grp string, rev double")


@pytest.mark.parametrize("per_range", [7, 100, 10**6])
def test_median_equals_median_of_all_copies(spark, per_range):
    """The two passes against the same draws looked at all at once."""
    df = frame(spark)
    got = abtest.bootstrap_differences(df, "rev", "grp", iterations=40, statistic="median", values_per_range=per_range)
    got = {r["iteration"]: r["difference"] for r in got.collect()}
    inputs = abtest._resample_inputs(df, "rev", "grp", ("A", "B"), False, None).toPandas()
    copies = draws.poisson(inputs["key"].to_numpy(), inputs["lam"].to_numpy(), np.arange(40), 0)
    for i in range(40):
        middle = [
            np.median(np.repeat(inputs["value"][inputs["arm"] == arm], copies[inputs["arm"] == arm, i])) for arm in "AB"
        ]
        assert got[i] == pytest.approx(middle[0] - middle[1])


def test_median_draws_one_range_only(spark):
    """Rows that are looked at closely: values of a range or two, times iterations, times arms."""
    inputs = abtest._resample_inputs(frame(spark), "rev", "grp", ("A", "B"), False, None)
    rows = abtest._middle_copies(inputs, 40, 0, 20)
    in_range = order_stats.value_ranges(inputs, 20).groupBy("arm", "range").count().agg(F.max("count")).first()[0]
    assert inputs.count() > 500 and rows.count() <= 2 * 2 * in_range * 40


@pytest.mark.parametrize("coarse", [1024, 8, 2])
def test_ranges_rise_and_stay_short(spark, monkeypatch, coarse):
    """Cut once by the driver, or again inside each coarse range."""
    monkeypatch.setattr(order_stats, "COARSE", coarse)
    values = np.random.default_rng(2).lognormal(0, 3, 4000)
    df = order_stats.staged_counts(spark.createDataFrame([(float(v),) for v in values], "v double"), "v")
    rows = sorted((r["value"], r["range"]) for r in order_stats.value_ranges(df, 100).collect())
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:])) and len(rows) == len(set(values))
    sizes = np.unique([r[1] for r in rows], return_counts=True)[1]
    assert 40 <= len(sizes) <= 60 and sizes.max() <= 250
    ranked = sorted(order_stats.running_counts(df, values_per_range=100).collect())
    assert [r["before"] for r in ranked] == list(range(4000))
