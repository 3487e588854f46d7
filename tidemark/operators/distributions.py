"""Tables behind summaries and charts of one numeric column, by group.

``weight`` names a column that says how often a row counts; without it every row counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.order_stats import quantiles_of_counts, staged_counts


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def frequency(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Rows per distinct value, most common first."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(_rows(weight).alias("n"))
        .orderBy(*by, F.desc("n"), value)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with the number of times. Rows with a null are left out."""
    complete = df.dropna()
    return complete.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def describe(df: DataFrame, value: str, by: str, weight: str | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per group.

    Everything comes from the staged counts of distinct values, so ``df`` is computed once. The
    spread is summed around the median, which keeps the digits when the values are large.
    """
    counts = staged_counts(df, value, [by], weight)
    quartiles = quantiles_of_counts(counts, [0.25, 0.5, 0.75], [by])
    off = F.col("value") - F.col("quantiles")[1]
    n = F.col("count")
    variance = F.try_divide(F.col("off2") - F.col("off1") * F.col("off1") / n, n - 1)
    return (
        counts.join(quartiles, by)
        .groupBy(by, "quantiles")
        .agg(
            F.sum("n").alias("count"),
            F.sum(F.col("n") * off).alias("off1"),
            F.sum(F.col("n") * off * off).alias("off2"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .select(
            by,
            "count",
            (F.col("quantiles")[1] + F.col("off1") / n).alias("mean"),
            F.sqrt(F.when(variance < 0, 0.0).otherwise(variance)).alias("std"),
            "min",
            *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
            "max",
        )
    )


def box_summary(df: DataFrame, value: str, by: str, weight: str | None = None) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and number of points beyond, per group."""
    counts = staged_counts(df, value, [by], weight)
    box = quantiles_of_counts(counts, [0.25, 0.5, 0.75], [by])
    q1, q2, q3 = (F.col("quantiles")[i] for i in range(3))
    reach = 1.5 * (q3 - q1)
    inside = F.col("value").between(q1 - reach, q3 + reach)
    return (
        counts.join(box, by)
        .groupBy(by, "quantiles")
        .agg(
            F.sum("n").alias("count"),
            F.min(F.when(inside, F.col("value"))).alias("low"),
            F.max(F.when(inside, F.col("value"))).alias("high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            by,
            "count",
            q1.alias("q25"),
            q2.alias("q50"),
            q3.alias("q75"),
            F.least(F.coalesce("low", q1), q1).alias("whisker_low"),
            F.greatest(F.coalesce("high", q3), q3).alias("whisker_high"),
            "outliers",
        )
    )


def histogram(
    df: DataFrame, value: str, width: float, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Rows per bin of fixed ``width``, bins counted from zero. One pass, no limits needed."""
    place = F.floor(F.col(value).cast("double") / F.lit(float(width)))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, (place * F.lit(float(width))).alias("bin_start"))
        .agg(_rows(weight).alias("n"))
        .withColumn("bin_end", F.col("bin_start") + F.lit(float(width)))
    )


def histogram_bins(
    df: DataFrame, value: str, bins: int, weight: str | None = None
) -> DataFrame:
    """Rows per bin when the range from minimum to maximum is cut into ``bins`` equal parts."""
    number = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(number).alias("lo"), F.max(number).alias("hi"))).scalar()
    width = (F.col("span.hi") - F.col("span.lo")) / F.lit(float(bins))
    place = F.least(
        F.coalesce(F.floor(F.try_divide(number - F.col("span.lo"), width)), F.lit(0)), F.lit(bins - 1)
    )
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("span", span)
        .groupBy(
            place.alias("bin"),
            (F.col("span.lo") + place * width).alias("bin_start"),
            (F.col("span.lo") + (place + 1) * width).alias("bin_end"),
        )
        .agg(_rows(weight).alias("n"))
        .orderBy("bin")
    )


# distributions of any set of days, from one sketch a day

#: Size of a quantile sketch, and how far the rank of what it returns may be off, as a share of all rows.
SKETCH_SIZE = 800
RANK_ERROR = 1.5 * 2.296 / SKETCH_SIZE**0.9021


def daily_value_sketches(df: DataFrame, value: str, time: str, by: Sequence[str] = ()) -> DataFrame:
    """date, by.., sketch, count, total, min, max of each day: to be stored and merged over any set of days."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*by, F.to_date(time).alias("date"), number.alias("value")).where(F.col("value").isNotNull())
    return rows.groupBy("date", *by).agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH_SIZE)).alias("sketch"),
        F.count("value").alias("count"),
        F.sum("value").alias("total"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def describe_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by.., count, mean, min, q25, q50, q75, max and the ends of whiskers of the days in ``sketches``.

    Count, mean, minimum and maximum are exact. The rank of a quartile is off by RANK_ERROR at most. Whiskers reach
    1.5 interquartile ranges, or to the extremes if these are nearer.
    """
    merged = sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.sum("count").alias("count"),
        F.sum("total").alias("total"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    shares = F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)])
    found = merged.withColumn("q", F.kll_sketch_get_quantile_double("sketch", shares))
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    return found.select(
        *by,
        "count",
        (F.col("total") / F.col("count")).alias("mean"),
        "min",
        q1.alias("q25"),
        q2.alias("q50"),
        q3.alias("q75"),
        "max",
        F.greatest(q1 - 1.5 * (q3 - q1), "min").alias("whisker_low"),
        F.least(q3 + 1.5 * (q3 - q1), "max").alias("whisker_high"),
    )
