"""A/B evaluation and course queries against closed forms and brute force."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import tails
from tidemark.operators import abtest, courses, distributions
from tidemark.plans import jobs
from tidemark.sources.fixtures import view

SF_DIR = "/root/testdata/sf0.01"


def arms(spark, a, b):
    made = [("A", float(x)) for x in a] + [("B", float(x)) for x in b]
    return spark.createDataFrame(made, "grp string, rev double")


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))


def test_mann_whitney_disjoint(spark):
    got = abtest.mann_whitney(arms(spark, [1, 2, 3], [4, 5, 6]), "rev", "grp").first()
    assert (got.n_a, got.n_b, got.u, got.ties) == (3, 3, 0.0, 0.0)


def test_mann_whitney_with_ties(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, 130), rng.integers(2, 13, 90)
    got = abtest.mann_whitney(arms(spark, a, b), "rev", "grp").first()
    u, n = brute_u(a, b), 220
    ties = sum(int(t) ** 3 - int(t) for t in np.unique(np.r_[a, b], return_counts=True)[1])
    spread = math.sqrt(130 * 90 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, 130 * 90 - u) - 130 * 45 - 0.5) / spread
    assert (got.u, got.ties) == (u, ties)
    assert got.p_value == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_mann_whitney_of_equal_samples(spark):
    got = abtest.mann_whitney(arms(spark, [1, 2], [1, 2]), "rev", "grp").first()
    assert got.u == 2.0 and got.p_value == 1.0
    same = abtest.mann_whitney(arms(spark, [1, 1], [1, 1]), "rev", "grp").first()
    assert same.p_value is None


def test_chi_square_two_by_two(spark):
    counts = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 40)], "r string, c string, n long"
    )
    got = abtest.chi_square(counts, "r", "c").first()
    wanted = (abs(10 * 40 - 20 * 30) - 50) ** 2 * 100 / (30 * 70 * 40 * 60)
    assert got.statistic == pytest.approx(wanted) and got.dof == 1
    assert got.p_value == pytest.approx(math.erfc(math.sqrt(wanted / 2)))


def test_chi_square_with_an_empty_cell(spark):
    counts = spark.createDataFrame(
        [("a", "x", 10), ("b", "x", 30), ("b", "y", 40)], "r string, c string, n long"
    )
    wanted = (10 * 40 - 40) ** 2 * 80 / (10 * 70 * 40 * 40)
    assert abtest.chi_square(counts, "r", "c").first().statistic == pytest.approx(wanted)


def test_chi_square_larger_table(spark):
    table = np.array([[12, 30, 9], [22, 0, 41]])
    made = [(f"r{i}", f"c{j}", int(table[i, j])) for i in range(2) for j in range(3)]
    got = abtest.chi_square(spark.createDataFrame(made, "r string, c string, n long"), "r", "c").first()
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    wanted = ((table - expected) ** 2 / expected).sum()
    assert got.statistic == pytest.approx(wanted) and got.dof == 2
    assert got.p_value == pytest.approx(math.exp(-wanted / 2))


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 7, 10])
def test_chi_square_tail(dof):
    x = np.linspace(1e-9, 400, 800_001)
    density = x ** (dof / 2 - 1) * np.exp(-x / 2) / (2 ** (dof / 2) * math.gamma(dof / 2))
    for stat in (0.5, 3.0, 11.0):
        at = np.searchsorted(x, stat)
        wanted = np.trapezoid(density[at:], x[at:])
        found = tails.chi_square_tail.func(pd.Series([x[at]]), pd.Series([dof]))
        assert found[0] == pytest.approx(wanted, rel=1e-4)


def test_exact_mann_whitney(spark):
    """Against all ways to choose the first arm's ranks; ties and large samples get no p-value."""
    from itertools import combinations

    for a, b in (([3, 1, 7], [2, 9, 8, 6]), ([1, 2, 3, 4], [5, 6, 7]), ([5], [1])):
        got = abtest.mann_whitney_exact(arms(spark, a, b), "rev", "grp").first()
        u = sum(x > y for x in a for y in b)
        ways = [sum(r) - len(a) * (len(a) - 1) // 2 for r in combinations(range(len(a) + len(b)), len(a))]
        far = max(u, len(a) * len(b) - u)
        assert (got.n_a, got.n_b, got.u) == (len(a), len(b), u)
        assert got.p_value == pytest.approx(min(1, 2 * sum(w >= far for w in ways) / len(ways)))
    assert abtest.mann_whitney_exact(arms(spark, [1, 2], [2, 3]), "rev", "grp").first().p_value is None
    assert abtest.mann_whitney_exact(arms(spark, range(101), range(200, 300)), "rev", "grp").first().p_value is None


def test_exact_tail_approaches_the_normal_one():
    u, n = 1300.0, 60
    z = (abs(u - n * n / 2) - 0.5) / math.sqrt(n * n * (2 * n + 1) / 12)
    assert abtest.exact_u_tail(u, n, n) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=0.05)


def test_bootstrap_spread_and_seed(spark):
    rng = np.random.default_rng(2)
    a, b = rng.lognormal(1, 1, 4000).round(2), rng.lognormal(1.02, 1, 3000).round(2)
    df = arms(spark, a, b)
    run = lambda d, **k: abtest.bootstrap_summary(abtest.bootstrap_differences(d, "rev", "grp", **k)).first()
    got = run(df)
    assert got.iterations == 1000
    assert got["std"] == pytest.approx(math.sqrt(a.var() / 4000 + b.var() / 3000), rel=0.1)
    assert got["mean"] == pytest.approx(a.mean() - b.mean(), abs=4 * got["std"] / math.sqrt(1000))
    assert got.low < got["mean"] < got.high
    assert got.p_value == pytest.approx(math.erfc(abs(got["mean"]) / got["std"] / math.sqrt(2)))
    again = run(df.repartition(3, "rev"))  # neither the layout nor a second run matters
    assert tuple(again) == pytest.approx(tuple(got), rel=1e-9)
    assert run(df, seed=1).low != got.low


def test_bootstrap_with_the_size_of_the_first_arm(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(10, 3, 400).round(2), rng.normal(10, 3, 6400).round(2)
    run = lambda **k: abtest.bootstrap_summary(
        abtest.bootstrap_differences(arms(spark, a, b), "rev", "grp", **k)
    ).first()
    assert run(literal_n=True)["std"] == pytest.approx(math.sqrt((a.var() + b.var()) / 400), rel=0.12)
    assert run()["std"] == pytest.approx(math.sqrt(a.var() / 400 + b.var() / 6400), rel=0.12)


def test_bootstrap_with_numbered_arms(spark):
    df = spark.createDataFrame([(i % 2, float(i % 7)) for i in range(400)], "arm int, x double")
    got = abtest.bootstrap_differences(df, "x", "arm", (0, 1), iterations=20)
    assert got.where("difference is not null").count() == 20


def test_bootstrap_other_statistics(spark):
    rng = np.random.default_rng(9)
    df = arms(spark, rng.integers(0, 50, 301), rng.integers(20, 70, 301))
    median = abtest.bootstrap_differences(df, "rev", "grp", iterations=50, statistic="median")
    share = lambda value, weight: F.sum(F.when(value > 30, weight).otherwise(0)) / F.sum(weight)
    large = abtest.bootstrap_differences(df, "rev", "grp", iterations=50, statistic=share)
    assert median.count() == large.count() == 50
    assert -30 < median.agg(F.avg("difference")).first()[0] < -10
    assert -0.6 < large.agg(F.avg("difference")).first()[0] < -0.2


def test_bootstrap_histogram(spark):
    df = arms(spark, range(100), range(40, 140))
    got = abtest.bootstrap_histogram(abtest.bootstrap_differences(df, "rev", "grp")).toPandas()
    assert got.n.sum() == 1000 and got.bin.max() == 49
    assert 0.02 < got[got.is_tail].n.sum() / 1000 < 0.09
    assert got.is_tail.iloc[0] and got.is_tail.iloc[-1] and not got.is_tail.all()


def ab_tables(spark):
    groups = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "B")], "id long, grp string")
    added = spark.createDataFrame([(5, "B"), (6, "C")], "user_no long, variant string")
    active = spark.createDataFrame([(1,), (3,), (6,)], "student_id long")
    checks = spark.createDataFrame([(2, 100.0), (3, 1900.0001), (9, 5.0)], "student_id long, rev double")
    return groups, added, active, checks


def test_participants(spark):
    users = abtest.active_or_paying(abtest.participants(*ab_tables(spark)))
    assert rows(users, "student_id") == [
        (1, "A", 0.0, "yes", 1),
        (2, "A", 100.0, "no", 1),
        (3, "B", 1900.0001, "yes", 1),
        (6, "C", 0.0, "yes", 1),
    ]
    members = abtest.participants(*ab_tables(spark))
    assert rows(abtest.payers(members), "grp") == [("A", 1), ("B", 1)]
    assert rows(abtest.inactive_payers(members), "grp") == [("A", 1)]


def test_group_metrics_for_any_number_of_groups(spark):
    got = abtest.recalculated_metrics(*ab_tables(spark)).collect()
    assert [tuple(r) for r in got] == [
        ("A", 2, 50.0, 100.0, 0.5, 100.0),
        ("B", 1, 1900.0001, 1900.0001, 1.0, 1900.0001),
        ("C", 1, 0.0, None, 0.0, 0.0),
    ]
    users = abtest.active_or_paying(abtest.participants(*ab_tables(spark)))
    assert [tuple(r) for r in abtest.pay_crosstab(users).collect()] == [("A", 1, 1), ("B", 0, 1), ("C", 1, 0)]


def test_repeated_entries_count_as_the_merged_rows_would(spark):
    groups = pd.DataFrame({"id": [1, 2, 3, 4], "grp": list("AABB")})
    active = pd.DataFrame({"student_id": [1, 1, 3]})
    checks = pd.DataFrame({"student_id": [1, 1, 1, 2, 2, 3], "rev": [10.0, 10, 20, 5, 5, 7]})
    merged = groups.rename(columns={"id": "student_id"}).merge(checks, "left").fillna({"rev": 0})
    merged = merged.merge(active.assign(active="yes"), "left").fillna({"active": "no"})
    merged = merged[(merged.active == "yes") | (merged.rev > 0)]

    make = spark.createDataFrame
    empty = make([], "id long, grp string")
    users = abtest.active_or_paying(
        abtest.participants(make(groups), empty, make(active), make(checks))
    )
    got = {r.grp: r for r in abtest.group_metrics(users).collect()}
    for grp, part in merged.groupby("grp"):
        paying = part[part.rev > 0]
        assert got[grp]["count"] == len(part) and got[grp].Revenue == part.rev.sum()
        assert got[grp].ARPPU == round(part.rev.sum() / len(paying), 4)
    counts = distributions.describe(users, "rev", "grp", "times").toPandas().set_index("grp")
    wanted = merged.groupby("grp").rev.describe()
    assert np.allclose(counts["std"], wanted["std"], equal_nan=True)
    assert np.allclose(counts.q50, wanted["50%"]) and (counts["count"] == wanted["count"]).all()
    a, b = (merged[merged.grp == g].rev.to_numpy() for g in "AB")
    assert abtest.mann_whitney(users, "rev", "grp", weight="times").first().u == brute_u(a, b)


def test_experiment_report(spark):
    tables = [view(spark, SF_DIR, n) for n in ("groups", "groups_add", "active_studs", "checks")]
    report = jobs.experiment_report(*tables)
    assert report["metrics"].count() == 2
    for name in ("conversion", "per_user", "per_payer", "per_user_bootstrap", "per_payer_bootstrap"):
        assert 0 <= report[name].first().p_value <= 1


def test_describe_large_values(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"g": ["a"] * 500 + ["b"] * 3 + ["c"], "v": 1e9 + rng.normal(0, 1, 504)})
    got = distributions.describe(spark.createDataFrame(frame), "v", "g").toPandas().set_index("g")
    wanted = frame.groupby("g").v.describe()
    for mine, theirs in zip(
        ("count", "mean", "std", "min", "q25", "q50", "q75", "max"),
        ("count", "mean", "std", "min", "25%", "50%", "75%", "max"),
    ):
        assert np.allclose(got[mine].astype(float), wanted[theirs], rtol=1e-9, equal_nan=True), mine


def test_box_whiskers(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100, -80]
    got = distributions.box_summary(arms(spark, values, [5]), "rev", "grp")
    a, b = sorted(got.collect(), key=lambda r: r.grp)
    q25, q75 = np.quantile(values, [0.25, 0.75])
    assert (a.q25, a.q75, a.whisker_low, a.whisker_high, a.outliers) == (q25, q75, 1, 9, 2)
    assert tuple(b)[1:] == (1, 5.0, 5.0, 5.0, 5.0, 5.0, 0)


def test_histograms(spark):
    df = arms(spark, [0, 49.9, 50, -1], [7])
    assert rows(distributions.histogram(df, "rev", 50, ["grp"]), "grp", "bin_start") == [
        ("A", -50.0, 1, 0.0),
        ("A", 0.0, 2, 50.0),
        ("A", 50.0, 1, 100.0),
        ("B", 0.0, 1, 50.0),
    ]
    bins = distributions.histogram_bins(arms(spark, range(11), []), "rev", 5).collect()
    assert [r.n for r in bins] == [2, 2, 2, 2, 3]
    assert distributions.histogram_bins(arms(spark, [3, 3], []), "rev", 5).first().n == 2


def test_duplicates_and_frequencies(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 6.0), (2, None), (2, None)], "id int, rev double")
    assert [tuple(r) for r in distributions.duplicate_rows(df).collect()] == [(1, 5.0, 2)]
    assert [tuple(r) for r in distributions.frequency(df, "rev").collect()] == [(5.0, 2), (6.0, 1)]


def peas(spark, *solved):
    made = [(s, t, ok, subject) for s, t, ok, subject, times in solved for _ in range(times)]
    return spark.createDataFrame(made, "st_id int, timest timestamp, correct boolean, subject string")


def test_diligent_students(spark):
    october = dt.datetime(2021, 10, 31, 23, 59)
    df = peas(
        spark,
        (1, october, True, "Math", 20),
        (2, october, True, "Math", 19),
        (2, october, False, "Math", 5),
        (3, dt.datetime(2021, 11, 1), True, "Math", 30),
    )
    assert courses.diligent_students(df, dt.date(2021, 10, 1)).first()[0] == 1


def test_funnel(spark):
    at = dt.datetime(2021, 10, 1)
    studs = spark.createDataFrame(
        [(1, "control"), (2, "control"), (3, "pilot"), (4, "none")], "st_id int, test_grp string"
    )
    solved = peas(
        spark, (1, at, True, "Math", 11), (2, at, True, "Math", 1), (3, at, True, "Art", 10), (7, at, True, "Math", 50)
    )
    checks = spark.createDataFrame(
        [(1, at, 100, "Math"), (1, at, 50, "Art"), (2, at, 10, "Math"), (7, at, 999, "Math")],
        "st_id int, sale_time timestamp, money int, subject string",
    )
    got = {r.test_grp: tuple(r)[1:] for r in courses.funnel_metrics(studs, solved, checks).collect()}
    assert got == {
        "control": (80.0, 160.0, 1.5, 3.0, 2.0),
        "pilot": (0.0, None, 0.0, None, None),
        "none": (0.0, None, 0.0, None, None),
    }


def test_funnel_counts_a_repeated_student_as_the_rows_would(spark):
    at = dt.datetime(2021, 10, 1)
    studs = spark.createDataFrame([(1, "a"), (1, "a")], "st_id int, test_grp string")
    checks = spark.createDataFrame(
        [(1, at, 10, "Math")], "st_id int, sale_time timestamp, money int, subject string"
    )
    got = courses.funnel_metrics(studs, peas(spark, (1, at, True, "Math", 6)), checks).first()
    assert tuple(got) == ("a", 10.0, 20.0, 1.0, 2.0, 2.0)
