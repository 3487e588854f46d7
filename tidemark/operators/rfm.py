"""Recency, frequency and monetary segments of customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_double, money, whole_days
from tidemark.functions.order_stats import VALUES_PER_RANGE, quantiles
from tidemark.operators.commerce import successful
from tidemark.session import stage

QUINTILES = [0.2, 0.4, 0.6, 0.8]

# fixed values: segment by the scores for recency and frequency, as patterns
SEGMENTS = {
    "[1-2]1": "inactive",
    "[1-2]2": "at risk",
    "[1-2]3": "can not loose",
    "31": "doubt",
    "32": "need attention",
    "[3-4]3": "loyal customers",
    "41": "hopeful",
    "51": "new customers",
    "[4-5]2": "potential loyalists",
    "53": "ideal customer",
}


def customer_totals(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Last successful order, number of orders and money spent per customer.

    Orders are added up per customer_id before they meet the customers. That aggregate already
    lies where the join needs it, so only the customers move.
    """
    prices = items.groupBy("order_id").agg(F.sum(money("price")).alias("price_orders"))
    per_id = (
        successful(orders)
        .select("customer_id", "order_id", "order_purchase_timestamp")
        .join(prices, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_order"),
            F.count("order_id").alias("frequency"),
            F.sum("price_orders").alias("monetary"),
        )
    )
    people = customers.select("customer_id", "customer_unique_id")
    return (
        people.where(F.col("customer_unique_id").isNotNull())
        .join(per_id, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("last_order").alias("last_order"),
            F.sum("frequency").alias("frequency"),
            as_double(F.sum("monetary")).alias("monetary"),
        )
    )


def rfm_base(totals: DataFrame) -> DataFrame:
    """Recency in whole days, counted from one day after the last order of all.

    Takes the staged result of ``customer_totals``: the last order is read from it once more.
    """
    now = totals.agg(F.max("last_order") + F.expr("INTERVAL 1 DAY")).scalar()
    return totals.select(
        "customer_unique_id",
        whole_days("last_order", now).cast("bigint").alias("recency"),
        "frequency",
        "monetary",
    )


def staged_base(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """``rfm_base`` over totals kept in the shared folder, since the quintiles and the scores
    read them again."""
    return rfm_base(stage(customer_totals(customers, orders, items), "rfm"))


def quintile_row(base: DataFrame, values_per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """One row with three arrays of quintile bounds.

    Recency has as many distinct values as the shop has days and frequency few, so Spark's exact
    percentile holds them in one small buffer. Money has no such bound and is ranked in ranges.
    """
    days = base.agg(
        F.percentile("recency", QUINTILES).alias("recency"),
        F.percentile("frequency", QUINTILES).alias("frequency"),
    )
    money = quantiles(base, "monetary", QUINTILES, values_per_range=values_per_range).scalar()
    return days.withColumn("monetary", money)


def rfm_quintiles(base: DataFrame, values_per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """Quintile bounds as rows: quantile, recency, frequency, monetary."""
    shares = F.array(*[F.lit(q) for q in QUINTILES]).alias("quantile")
    zipped = F.arrays_zip(shares, "recency", "frequency", "monetary")
    return quintile_row(base, values_per_range).select(F.inline(zipped))


def _score(value: str, bounds: Column, scores: list[int]) -> Column:
    ladder = F.when(F.col(value) <= bounds[0], scores[0])
    for i in range(1, 4):
        ladder = ladder.when(F.col(value) <= bounds[i], scores[i])
    return ladder.otherwise(scores[4])


def rfm(base: DataFrame) -> DataFrame:
    """Scores and segment of every customer."""
    bounds = quintile_row(base).select(F.struct("recency", "monetary")).scalar()
    frequency = F.when(F.col("frequency") == 1, 1).when(F.col("frequency") == 2, 2).otherwise(3)
    scored = (
        base.withColumn("bounds", bounds)
        .withColumns(
            {
                "R": _score("recency", F.col("bounds.recency"), [5, 4, 3, 2, 1]),
                "F": frequency,
                "M": _score("monetary", F.col("bounds.monetary"), [1, 2, 3, 4, 5]),
            }
        )
        .drop("bounds")
    )
    pair = F.concat(F.col("R").cast("string"), F.col("F").cast("string"))
    segment = F.coalesce(
        *[F.when(pair.rlike(f"^{pattern}$"), F.lit(name)) for pattern, name in SEGMENTS.items()], pair
    )
    return scored.withColumn(
        "rfm_score", F.concat(pair, F.col("M").cast("string"))
    ).withColumn("segment", segment)


def segment_share(scored: DataFrame) -> DataFrame:
    """Customers per segment and their share in percent, cut to a whole number."""
    counts = scored.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    folded = counts.agg(
        F.collect_list(F.struct("segment", "customers")).alias("rows"), F.sum("customers").alias("all")
    )  # at most one row per segment
    return (
        folded.select(F.inline("rows"), "all")
        .withColumn("percent", F.floor(F.col("customers") * 100 / F.col("all")))
        .withColumn(
            "label",
            F.concat(
                F.format_number("customers", 0), F.lit(" ("), F.col("percent").cast("string"), F.lit("%)")
            ),
        )
        .drop("all")
        .orderBy("customers", "segment")
    )


def segment_bounds(scored: DataFrame) -> DataFrame:
    """Smallest and largest recency, frequency and monetary value of each segment."""
    limits = []
    for name in ("recency", "frequency", "monetary"):
        limits += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    return scored.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), *limits)


def frequency_counts(base: DataFrame) -> DataFrame:
    """How many customers have each number of orders, most common first."""
    return (
        base.groupBy("frequency")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "frequency")
    )
