"""Orders of a shop.

``customers``: customer_id (one per order), customer_unique_id (one per person).
``orders``: order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at.
``items``: order_id, product_id, price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import month_start, not_in, ratio, round_even

# fixed values: the statuses of an order that did not reach the customer
UNDELIVERED = ("canceled", "unavailable")

# fixed values: weekday names in alphabetical order, with their number counted from Monday = 0
WEEKDAYS = {
    "Friday": 4,
    "Monday": 0,
    "Saturday": 5,
    "Sunday": 6,
    "Thursday": 3,
    "Tuesday": 1,
    "Wednesday": 2,
}


def successful(orders: DataFrame) -> DataFrame:
    """Approved orders that were neither canceled nor unavailable; an unknown status counts."""
    return orders.where(
        F.col("order_approved_at").isNotNull() & not_in("order_status", UNDELIVERED)
    )


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Purchase time of every order with the person who placed it.

    Customers without an order carry nothing that any analysis counts, so the join is an inner one.
    """
    people = customers.select("customer_id", "customer_unique_id")
    placed = orders.select("customer_id", "order_id", "order_purchase_timestamp")
    return people.where(F.col("customer_unique_id").isNotNull()).join(placed, "customer_id")


def single_purchase_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: customers with exactly one successful order."""
    bought = successful(orders).select("customer_id").distinct()
    return (
        customers.where(F.col("customer_unique_id").isNotNull())
        .join(bought, "customer_id", "left_semi")
        .groupBy("customer_unique_id")
        .agg(F.count("customer_id").alias("n"))
        .agg(F.count_if(F.col("n") == 1).alias("customers"))
    )


def customers_total(customers: DataFrame) -> DataFrame:
    """One row: distinct customers."""
    return customers.agg(F.count_distinct("customer_unique_id").alias("customers"))


def undelivered_monthly(orders: DataFrame) -> DataFrame:
    """Undelivered orders per reason and month; ``label`` is the month as text."""
    return (
        orders.where(F.col("order_status").isin(*UNDELIVERED))
        .where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy("order_status", month_start("order_purchase_timestamp").alias("month"))
        .agg(F.count("order_id").alias("orders"))
        .withColumn("label", F.date_format("month", "yyyy-MM"))
    )


def undelivered_by_reason(monthly: DataFrame) -> DataFrame:
    """Mean and median of the monthly numbers per reason, over the months that have any."""
    return monthly.groupBy("order_status").agg(
        F.avg("orders").alias("mean_orders"), F.median("orders").alias("median_orders")
    )


def product_weekday_mode(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Weekdays on which a product is in most orders; all of them, sorted, when several tie.

    A product counts once per order. The seven counts are columns of one aggregate, so a
    product in very many orders is added up before the shuffle and needs no ranking.
    """
    once = items.select("order_id", "product_id").dropDuplicates()
    bought = orders.select("order_id", F.weekday("order_purchase_timestamp").alias("weekday"))
    counts = (
        once.where(F.col("product_id").isNotNull())
        .join(bought, "order_id", "left")
        .groupBy("product_id")
        .agg(*[F.count_if(F.col("weekday") == i).alias(name) for name, i in WEEKDAYS.items()])
        .withColumn("top", F.greatest(*WEEKDAYS))
    )
    named = [
        F.when((F.col(name) == F.col("top")) & (F.col("top") > 0), F.lit(name)) for name in WEEKDAYS
    ]
    return counts.select("product_id", F.array_compact(F.array(*named)).alias("day_of_week"))


def orders_per_week(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Successful orders per customer and month, and their mean number per week of the month."""
    return purchases_per_week(purchases(customers, orders))


def purchases(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """customer_unique_id, order_id, order_purchase_timestamp of the successful orders.

    Written by ``sources.tables.write_clustered``, one customer's rows are found without reading the others'.
    """
    timed = customer_orders(customers, successful(orders)).where(F.col("order_purchase_timestamp").isNotNull())
    return timed.select("customer_unique_id", "order_id", "order_purchase_timestamp")


def purchases_per_week(purchased: DataFrame) -> DataFrame:
    """``orders_per_week`` from the rows of ``purchases``."""
    month = month_start("order_purchase_timestamp").alias("month")
    days = F.day(F.last_day("month"))
    return (
        purchased
        .groupBy("customer_unique_id", month)
        .agg(F.count("order_id").alias("count_orders"))
        .withColumn("count_of_days", days)
        .withColumn("count_of_weeks", round_even(days / F.lit(7.0), 2))
        .withColumn("avg_orders_by_week", round_even(ratio("count_orders", "count_of_weeks"), 3))
    )


def customer_history(weekly: DataFrame, customer: str | int) -> DataFrame:
    """One customer's months in time order. The choice is made before the join and the grouping."""
    return weekly.where(F.col("customer_unique_id") == F.lit(customer)).orderBy("month")


def order_span(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: first and last successful order and the seconds between them."""
    known = customers.where(F.col("customer_unique_id").isNotNull()).select("customer_id").distinct()
    first, last = F.min("first_order"), F.max("last_order")
    return (
        successful(orders)
        .groupBy("customer_id")
        .agg(
            F.min("order_purchase_timestamp").alias("first_order"),
            F.max("order_purchase_timestamp").alias("last_order"),
        )
        .join(known, "customer_id", "left_semi")
        .agg(
            first.alias("first_order"),
            last.alias("last_order"),
            F.timestamp_diff("SECOND", first, last).alias("span_seconds"),
        )
    )
