"""Exact ranks and quantiles without putting a whole column in one task.

Rows are first reduced to one row per distinct value, which removes hot values. The distinct
values are cut into ranges of similar length, counted per range, and ranked inside each range
from the count of everything before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.session import stage

VALUES_PER_RANGE = 100_000
#: Ranges that the driver names the ends of; finer ones are cut where the values are.
COARSE = 1024


def value_counts(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``(by.., value, n)``: number of rows, or sum of the whole-number column ``weight``."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*by, number.alias("value"), times.cast("bigint").alias("w"))
    keep = F.col("value").isNotNull()
    for key in by:
        keep = keep & F.col(key).isNotNull()
    return rows.where(keep).groupBy(*by, "value").agg(F.sum("w").alias("n"))


def staged_counts(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``value_counts`` kept in the shared folder: ranking reads them several times."""
    return stage(value_counts(df, value, by, weight), "value-counts")


def running_counts(
    counts: DataFrame, by: Sequence[str] = (), values_per_range: int = VALUES_PER_RANGE
) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` (all rows) within ``by``.

    ``counts`` holds one row per ``(by.., value)`` with a bigint ``n``; other columns are kept.
    It is read up to four times, so it should be staged.
    """
    if counts.count() <= values_per_range:
        inside = W.partitionBy(*by).orderBy("value").rowsBetween(W.unboundedPreceding, -1)
        return counts.withColumns(
            {
                "before": F.coalesce(F.sum("n").over(inside), F.lit(0)),
                "total": F.sum("n").over(W.partitionBy(*by)),
            }
        )

    rows = value_ranges(counts, values_per_range)
    keys = [*by, "range"]
    per_range = rows.groupBy(*keys).agg(F.sum("n").alias("in_range"))
    upto = W.partitionBy(*by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = per_range.select(
        *keys,
        F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("start"),
        F.sum("in_range").over(W.partitionBy(*by)).alias("total"),
    )
    inside = W.partitionBy(*keys).orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.join(starts, keys)
        .withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .select(*counts.columns, "before", "total")
    )


def value_ranges(counts: DataFrame, values_per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """``counts`` with ``range``, which rises with ``value``: ranges of some ``values_per_range`` rows.

    Up to COARSE ranges are cut by quantiles of the whole column, named by the driver. If more are needed, each
    of these is cut again by quantiles of its own values, found where they are and joined back by range,
    so what the driver sees doesn't grow with the column.
    """
    wanted = -(-counts.count() // values_per_range)
    if wanted < 2:
        return counts.withColumn("range", F.lit(0).cast("bigint"))
    coarse = min(wanted, COARSE)
    splits = _cuts(counts.agg(_quantiles(coarse)).first()[0])
    rows = Bucketizer(splits=splits, inputCol="value", outputCol="range").transform(counts)
    rows = rows.withColumn("range", F.col("range").cast("bigint"))
    finer = -(-wanted // coarse)
    if finer < 2:
        return rows
    inner = rows.groupBy("range").agg(_quantiles(finer).alias("cuts"))
    place = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
    return rows.join(inner, "range").withColumn("range", F.col("range") * (finer + 1) + place).select(*rows.columns)


def _quantiles(parts: int):
    shares = [i / parts for i in range(1, parts)]
    return F.percentile_approx("value", shares, max(10_000, 20 * parts))


def _cuts(found: list[float] | None) -> list[float]:
    return [float("-inf"), *sorted(set(found or [])), float("inf")]


def quantiles_of_counts(
    counts: DataFrame,
    probs: Sequence[float],
    by: Sequence[str] = (),
    values_per_range: int = VALUES_PER_RANGE,
) -> DataFrame:
    """``(by.., quantiles)``: exact quantiles, linear between neighbours, as an array."""
    last = F.col("total") - 1
    holds = lambda place: (F.col("before") <= place) & (place < F.col("before") + F.col("n"))
    picks = []
    for i, prob in enumerate(probs):
        place = last * F.lit(float(prob))
        picks += [
            F.max(F.when(holds(F.floor(place)), F.col("value"))).alias(f"lo{i}"),
            F.max(F.when(holds(F.ceil(place)), F.col("value"))).alias(f"hi{i}"),
            F.max(place - F.floor(place)).alias(f"part{i}"),
        ]
    mix = [
        F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")
        for i in range(len(probs))
    ]
    ranked = running_counts(counts, by, values_per_range)
    return ranked.groupBy(*by).agg(*picks).select(*by, F.array(*mix).alias("quantiles"))


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
    values_per_range: int = VALUES_PER_RANGE,
) -> DataFrame:
    """Exact quantiles of a column, see ``quantiles_of_counts``."""
    counts = staged_counts(df, value, by, weight)
    return quantiles_of_counts(counts, probs, by, values_per_range)
