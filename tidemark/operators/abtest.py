"""Evaluation of an experiment: who took part, group metrics, significance tests.

``groups``: id, grp. ``active``: student_id. ``checks``: student_id, rev.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions.draws import poisson
from tidemark.functions.exprs import money_sum, ratio, round_even, zero_sum
from tidemark.functions.order_stats import VALUES_PER_RANGE, running_counts, value_counts, value_ranges
from tidemark.functions.tails import chi_square_tail, normal_two_sided
from tidemark.operators.distributions import histogram_bins
from tidemark.session import stage
from tidemark.sources.files import align_headers


def paid() -> Column:
    return F.col("rev") > 0


# participants and group metrics


def participants(
    groups: DataFrame, groups_add: DataFrame, active: DataFrame, checks: DataFrame
) -> DataFrame:
    """Every member of a group with revenue (0 without a payment) and activity ('yes' or 'no').

    ``groups_add`` may have other column names; they are matched by position. Equal payments of
    a student and repeated entries in the list of active students are counted before the join;
    ``times`` says for how many rows of the merged tables a row stands, usually 1. A student
    with very many entries thus stays small, and all results below count ``times``.
    """
    members = groups.unionByName(align_headers(groups_add, groups)).withColumnRenamed(
        "id", "student_id"
    )
    amounts = checks.groupBy("student_id", "rev").agg(F.count(F.lit(1)).alias("payments"))
    seen = active.groupBy("student_id").agg(F.count(F.lit(1)).alias("entries"))
    once = F.lit(1)
    return (
        members.join(amounts, "student_id", "left")
        .join(seen, "student_id", "left")
        .select(
            "student_id",
            "grp",
            F.coalesce(F.nanvl("rev", F.lit(0.0)), F.lit(0.0)).alias("rev"),
            F.when(F.col("entries").isNull(), "no").otherwise("yes").alias("active"),
            (F.coalesce("payments", once) * F.coalesce("entries", once)).alias("times"),
        )
    )


def active_or_paying(members: DataFrame) -> DataFrame:
    return members.where((F.col("active") == "yes") | paid())


def payers(members: DataFrame) -> DataFrame:
    """Members with a payment per group."""
    return _members_by_group(members.where(paid()))


def inactive_payers(members: DataFrame) -> DataFrame:
    """Members with a payment who were never seen on the platform, per group."""
    return _members_by_group(members.where((F.col("active") == "no") & paid()))


def _members_by_group(members: DataFrame) -> DataFrame:
    return _named(members).groupBy("grp").agg(F.sum("times").alias("students"))


def _named(members: DataFrame) -> DataFrame:
    return members.where(F.col("grp").isNotNull() & F.col("student_id").isNotNull())


def group_metrics(users: DataFrame) -> DataFrame:
    """Members, mean revenue per member and per payer, share of payers and revenue per group."""
    return (
        _named(users)
        .groupBy("grp")
        .agg(
            F.sum("times").alias("count"),
            zero_sum(F.when(paid(), F.col("times"))).alias("paying"),
            money_sum(F.when(paid(), F.col("rev") * F.col("times"))).alias("Revenue"),
        )
        .select(
            "grp",
            "count",
            round_even(ratio("Revenue", "count"), 4).alias("ARPAU"),
            round_even(ratio("Revenue", "paying"), 4).alias("ARPPU"),
            round_even(ratio("paying", "count"), 4).alias("CR_buy"),
            round_even("Revenue", 4).alias("Revenue"),
        )
        .orderBy("grp")
    )


def recalculated_metrics(
    groups: DataFrame, groups_add: DataFrame, active: DataFrame, checks: DataFrame
) -> DataFrame:
    """Group metrics including a later list of members."""
    return group_metrics(active_or_paying(participants(groups, groups_add, active, checks)))


def metric_bars(metrics: DataFrame) -> DataFrame:
    """Group metrics as rows (grp, metric, value), one bar each."""
    names = ["Revenue", "ARPAU", "ARPPU", "CR_buy"]
    return metrics.select("grp", *names).unpivot("grp", names, "metric", "value")


# chi-square


def pay_counts(users: DataFrame) -> DataFrame:
    """Members by group and by whether they paid: grp, pay, n."""
    label = F.when(paid(), "pay").otherwise("no_pay")
    return (
        users.where(F.col("grp").isNotNull())
        .groupBy("grp", label.alias("pay"))
        .agg(F.sum("times").alias("n"))
    )


def pay_crosstab(users: DataFrame) -> DataFrame:
    """The same as a table: one row per group, columns no_pay and pay."""
    wide = pay_counts(users).groupBy("grp").pivot("pay", ["no_pay", "pay"]).agg(F.sum("n"))
    return wide.na.fill(0).orderBy("grp")


def chi_square(counts: DataFrame, row: str, column: str, n: str = "n") -> DataFrame:
    """Test of independence on cell counts; one row: statistic, dof, p_value.

    Two by two tables get Yates' correction. The sums run over the cells that occur, so empty
    cells need not be listed: without correction the statistic is sum(n^2 / expected) - total,
    and in a two by two table every cell is equally far from its expectation.
    """
    in_row, in_column = W.partitionBy(row), W.partitionBy(column)
    cells = counts.where(F.col(n) > 0).select(
        F.col(row).alias("row"),
        F.col(column).alias("column"),
        F.col(n).cast("double").alias("n"),
        F.sum(n).over(in_row).cast("double").alias("row_n"),
        F.sum(n).over(in_column).cast("double").alias("column_n"),
        F.count(F.lit(1)).over(in_row).alias("row_cells"),
        F.count(F.lit(1)).over(in_column).alias("column_cells"),
    )
    product = F.col("row_n") * F.col("column_n")
    sums = cells.agg(
        ((F.count_distinct("row") - 1) * (F.count_distinct("column") - 1)).alias("dof"),
        F.sum("n").alias("total"),
        F.max(F.struct("n", product.alias("product"))).alias("cell"),
        F.sum(1 / (F.col("row_n") * F.col("row_cells"))).alias("row_inverse"),
        F.sum(1 / (F.col("column_n") * F.col("column_cells"))).alias("column_inverse"),
        F.sum(F.col("n") * F.col("n") / product).alias("squares"),
    )
    off = F.abs(F.col("cell.n") - F.col("cell.product") / F.col("total"))
    kept = F.greatest(off - 0.5, F.lit(0.0))
    corrected = kept * kept * F.col("total") * F.col("row_inverse") * F.col("column_inverse")
    plain = (F.col("squares") - 1) * F.col("total")
    return sums.select(
        F.when(F.col("dof") == 1, corrected).otherwise(plain).alias("statistic"), "dof"
    ).withColumn("p_value", chi_square_tail("statistic", "dof"))


# Mann-Whitney


def mann_whitney(
    df: DataFrame,
    value: str,
    group: str,
    arms: Sequence[str] = ("A", "B"),
    weight: str | None = None,
    values_per_range: int = VALUES_PER_RANGE,
) -> DataFrame:
    """Two-sided Mann-Whitney U test with midranks, tie and continuity correction; one row.

    ``u`` belongs to the first arm. The p-value is the normal approximation. ``weight`` names a
    column that says how often a row counts.
    """
    in_a, in_b = F.col(group) == arms[0], F.col(group) == arms[1]
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    times = F.lit(1) if weight is None else F.col(weight)
    size = lambda arm: zero_sum(F.when(arm, times.cast("bigint")))
    counts = (
        df.where(in_a | in_b)
        .groupBy(number.alias("value"))
        .agg(size(in_a).alias("n_a"), size(in_b).alias("n_b"))
        .where(F.col("value").isNotNull())
        .withColumn("n", F.col("n_a") + F.col("n_b"))
    )
    whole = lambda c: c.cast("decimal(38,0)")
    n = whole(F.col("n"))
    twice_rank = whole(2 * F.col("before") + F.col("n") + 1)
    sums = running_counts(stage(counts, "value-counts"), (), values_per_range).agg(
        F.sum("n_a").alias("n_a"),
        F.sum("n_b").alias("n_b"),
        F.sum(whole(F.col("n_a")) * twice_rank).cast("double").alias("twice_rank_sum"),
        F.sum(n * n * n - n).cast("double").alias("ties"),
    )
    a, b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    u = F.col("twice_rank_sum") / 2 - a * (a + 1) / 2
    total = a + b
    spread = F.sqrt(a * b / 12 * (total + 1 - F.try_divide(F.col("ties"), total * (total - 1))))
    away = F.greatest(F.col("u"), a * b - F.col("u")) - a * b / 2 - 0.5
    return (
        sums.withColumn("u", u)
        .withColumn("z", F.try_divide(away, spread))
        .withColumn("p_value", normal_two_sided(F.when(F.col("z") < 0, 0.0).otherwise(F.col("z"))))
        .select("n_a", "n_b", "u", "ties", "z", "p_value")
    )


#: Largest product of both sizes for which the exact distribution is worked out.
EXACT_CELLS = 10_000


def exact_u_tail(u: float, n_a: int, n_b: int) -> float:
    """Two-sided probability of a U at least as far from its middle, when all orders of n_a + n_b values are alike likely.

    ways[k] counts the orders with U = k, built up by adding one value of the first arm after the other.
    """
    ways = [1] + [0] * (n_a * n_b)
    for i in range(1, n_a + 1):  # the Gaussian binomial: times (1 - q^(n_b + i)) over (1 - q^i)
        for k in range(n_a * n_b, n_b + i - 1, -1):
            ways[k] -= ways[k - n_b - i]
        for k in range(i, n_a * n_b + 1):
            ways[k] += ways[k - i]
    far = int(max(u, n_a * n_b - u))
    return min(1.0, 2 * sum(ways[far:]) / sum(ways))


def mann_whitney_exact(
    df: DataFrame, value: str, group: str, arms: Sequence[str] = ("A", "B")
) -> DataFrame:
    """``n_a, n_b, u, p_value`` of the exact two-sided Mann-Whitney test, for small samples without ties.

    Samples with ties, or whose sizes multiply to more than EXACT_CELLS, have no p-value (null): the normal
    approximation of ``mann_whitney`` is meant for these.
    """
    test = mann_whitney(df, value, group, arms)
    small = (F.col("ties") == 0) & (F.col("n_a") * F.col("n_b")).between(1, EXACT_CELLS)

    @F.pandas_udf("double")
    def tail(u: pd.Series, n_a: pd.Series, n_b: pd.Series, small: pd.Series) -> pd.Series:
        rows = zip(u, n_a, n_b, small)
        return pd.Series([exact_u_tail(x, int(a), int(b)) if s else None for x, a, b, s in rows], dtype="float64")

    exact = tail("u", "n_a", "n_b", F.coalesce(small, F.lit(False)))
    return test.select("n_a", "n_b", "u", exact.alias("p_value"))


# bootstrap


#: Distinct values that a task draws for, and those of a range that a median is searched in.
VALUES_PER_TASK = 4096
#: Draws that are held at a time.
DRAWS = 1 << 18


def _resample_inputs(
    df: DataFrame,
    value: str,
    group: str,
    arms: Sequence[str],
    literal_n: bool,
    weight: str | None,
) -> DataFrame:
    """arm, value, lam (mean number of copies of its rows), key (what its draws depend on), staged."""
    rows = df.where(F.col(group).isin(*arms)).withColumn("arm", F.col(group).cast("string"))
    counts = stage(value_counts(rows, value, ["arm"], weight), "value-counts")
    lam = F.col("n").cast("double")
    if literal_n:
        size = lambda arm: F.sum(F.when(F.col("arm") == str(arm), F.col("n")).otherwise(0))
        share = counts.agg(ratio(size(arms[0]), size(arms[1]))).scalar()
        lam = F.when(F.col("arm") == str(arms[1]), lam * share).otherwise(lam)
    text = F.concat_ws("|", "arm", F.col("value").cast("string"))
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return counts.select("arm", "value", lam.alias("lam"), key.alias("key"))


def _tasks(inputs: DataFrame, by: str) -> DataFrame:
    """As many partitions as the values need, whatever the cluster looks like when the plan is made."""
    return inputs.repartition(max(1, -(-inputs.count() // VALUES_PER_TASK)), by)


def _drawn(batch: pd.DataFrame, iterations: np.ndarray, seed: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Slices of a batch with their matrix of copies (rows x iterations)."""
    step = max(1, DRAWS // max(1, len(iterations)))
    for start in range(0, len(batch), step):
        part = batch.iloc[start : start + step]
        yield part, poisson(part["key"].to_numpy(), part["lam"].to_numpy(), iterations, seed)


def _copies_by(inputs: DataFrame, keys: Sequence[str], iterations: int, seed: int) -> DataFrame:
    """(keys.., iteration, total, count): the drawn copies and the sum of their values.

    A task passes on one row for each of its keys and iteration, whatever the number of values.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for key, rows in batch.groupby(list(keys)):
                for part, copies in _drawn(rows, np.arange(iterations), seed):
                    total, count = held.get(key, (0, 0))
                    held[key] = (total + part["value"].to_numpy() @ copies, count + copies.sum(0))
        for key, (total, count) in held.items():
            named = dict(zip(keys, key))
            yield pd.DataFrame({**named, "iteration": np.arange(iterations), "total": total, "count": count})

    kinds = ", ".join(f"{k} {inputs.schema[k].dataType.simpleString()}" for k in keys)
    parts = inputs.mapInPandas(sums, f"{kinds}, iteration int, total double, count bigint")
    return parts.groupBy(*keys, "iteration").agg(F.sum("total").alias("total"), F.sum("count").alias("count"))


def _copies(inputs: DataFrame, seed: int, all_iterations: int | None = None) -> DataFrame:
    """(arm, iteration, value, weight) for every value and iteration that draws it.

    Without ``all_iterations``, each row names its own in a column ``iterations``, has a range, and keeps it.
    """
    kept = ["arm", "value"] if all_iterations else ["arm", "value", "range"]

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = [(None, batch)] if all_iterations else batch.groupby("picked")
            for _, rows in alike:
                wanted = np.arange(all_iterations) if all_iterations else np.asarray(rows["iterations"].iloc[0])
                for part, weight in _drawn(rows, wanted, seed):
                    row, column = np.nonzero(weight)
                    own = {c: part[c].to_numpy()[row] for c in kept}
                    yield pd.DataFrame({**own, "iteration": wanted[column], "weight": weight[row, column]})

    schema = "arm string, value double, " + ("" if all_iterations else "range bigint, ")
    return inputs.mapInPandas(copies, schema + "iteration int, weight bigint")


def _middle_copies(inputs: DataFrame, iterations: int, seed: int, values_per_range: int) -> DataFrame:
    """(arm, iteration, value, weight, before, total) of the values around each iteration's middle.

    First pass: copies per iteration and range of values. Second pass: only the one or two ranges that hold
    the middle of an iteration are drawn once more, value by value. So there are as many rows as a range has
    values, times the iterations, however many values the column has.
    """
    ranged = stage(value_ranges(inputs, values_per_range), "value-ranges")
    per_range = _copies_by(_tasks(ranged, "range"), ["arm", "range"], iterations, seed).drop("total")
    line = W.partitionBy("arm", "iteration").orderBy("range")
    before = F.coalesce(F.sum("count").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("count").over(W.partitionBy("arm", "iteration"))
    holds = lambda place: (F.col("before") <= place) & (place < F.col("before") + F.col("count"))
    last = F.col("total") - 1
    picked = stage(
        per_range.withColumns({"before": before, "total": total})
        .where(holds(F.floor(last / 2)) | holds(F.ceil(last / 2)))
        .select("arm", "range", "iteration", "before", "total"),
        "median-ranges",
    )
    wanted = picked.groupBy("arm", "range").agg(
        F.sort_array(F.collect_list("iteration")).alias("iterations"),
        F.concat_ws("|", "arm", "range").alias("picked"),
    )
    again = stage(ranged.join(wanted, ["arm", "range"]), "median-values")
    return _copies(_tasks(again, "key"), seed).join(picked, ["arm", "range", "iteration"])


def _medians(inputs: DataFrame, iterations: int, seed: int, values_per_range: int) -> DataFrame:
    rows = stage(_middle_copies(inputs, iterations, seed, values_per_range), "median-copies")
    line = W.partitionBy("arm", "iteration", "range").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    begin = F.col("before") + F.coalesce(F.sum("weight").over(line), F.lit(0))
    holds = lambda place: (F.col("begin") <= place) & (place < F.col("begin") + F.col("weight"))
    last = F.col("total") - 1
    at = lambda place: F.max(F.when(holds(place), F.col("value")))
    ends = rows.withColumn("begin", begin).groupBy("arm", "iteration")
    ends = ends.agg(at(F.floor(last / 2)).alias("lo"), at(F.ceil(last / 2)).alias("hi"))
    return ends.select("arm", "iteration", (F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5).alias("statistic"))


def bootstrap_differences(
    df: DataFrame,
    value: str,
    group: str,
    arms: Sequence[str] = ("A", "B"),
    iterations: int = 1000,
    statistic: str | Callable[[Column, Column], Column] = "mean",
    seed: int = 0,
    literal_n: bool = False,
    weight: str | None = None,
    values_per_range: int = VALUES_PER_TASK,
) -> DataFrame:
    """(iteration, difference): statistic of the first arm minus that of the second, resampled.

    Works on distinct values with their counts: drawing each of n equal rows a Poisson(1) number of times
    gives Poisson(n) copies. A draw depends on seed, arm, value and iteration only, so neither
    partitioning nor a repeated task changes it. For the mean, each task adds up its own values for all
    iterations and passes on one row per arm and iteration. For "median" it does so per range of values, and
    only the range that holds the middle is looked at closely. ``statistic`` may also be a function from a value
    and a weight column to a Spark aggregate, which gets one row per value and iteration.

    ``literal_n=True`` draws as many rows for the second arm as the first one has. ``weight``
    names a column that says how often a row counts.
    """
    inputs = _resample_inputs(df, value, group, arms, literal_n, weight)
    if statistic == "mean":
        sums = _copies_by(_tasks(inputs, "key"), ["arm"], iterations, seed)
        by_arm = sums.withColumn("statistic", F.try_divide("total", "count"))
    elif statistic == "median":
        by_arm = _medians(inputs, iterations, seed, values_per_range)
    else:
        aggregate = statistic(F.col("value"), F.col("weight"))
        copies = _copies(_tasks(inputs, "key"), seed, iterations)
        by_arm = copies.groupBy("arm", "iteration").agg(aggregate.alias("statistic"))
    of = lambda arm: F.max(F.when(F.col("arm") == str(arm), F.col("statistic")))
    return by_arm.groupBy("iteration").agg((of(arms[0]) - of(arms[1])).alias("difference"))


def bootstrap_summary(differences: DataFrame, confidence: float = 0.95) -> DataFrame:
    """One row: iterations, mean, standard deviation, quantile interval, p_value."""
    tail = (1 - confidence) / 2
    return (
        differences.agg(
            F.count("difference").alias("iterations"),
            F.avg("difference").alias("mean"),
            F.stddev_pop("difference").alias("std"),
            F.percentile("difference", [tail, 1 - tail]).alias("ends"),
        )
        .withColumn("p_value", normal_two_sided(F.try_divide("mean", "std")))
        .select(
            "iterations",
            "mean",
            "std",
            F.col("ends")[0].alias("low"),
            F.col("ends")[1].alias("high"),
            "p_value",
        )
    )


def bootstrap_histogram(
    differences: DataFrame, bins: int = 50, confidence: float = 0.95
) -> DataFrame:
    """Histogram of the differences; bins that start outside the interval are marked."""
    rows = stage(differences, "bootstrap")
    ends = bootstrap_summary(rows, confidence).select(F.struct("low", "high")).scalar()
    outside = (F.col("bin_start") <= F.col("ends.low")) | (F.col("bin_start") >= F.col("ends.high"))
    return (
        histogram_bins(rows, "difference", bins)
        .withColumn("ends", ends)
        .withColumn("is_tail", outside)
        .drop("ends")
    )
