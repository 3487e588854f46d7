"""Cohorts of customers by the month of their first order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions.exprs import ratio
from tidemark.operators.commerce import customer_orders
from tidemark.session import stage


#: Months in a word of a customer's bitmap. Months are numbered from January of the year 0.
WORD = 62


def _month_number(time) -> Column:
    return F.year(time) * 12 + F.month(time) - 1


def _merged(bits: DataFrame, lo: int, hi: int) -> DataFrame:
    """customer_unique_id, months of rows (customer_unique_id, word, bits) with words from lo to hi."""
    word = lambda w: F.bit_or(F.when(F.col("word") == w, F.col("bits")).otherwise(0)).alias(f"w{w}")
    wide = bits.groupBy("customer_unique_id").agg(*[word(w) for w in range(lo, hi + 1)])
    listed = F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"w{w}").alias("bits")) for w in range(lo, hi + 1)])
    return wide.select("customer_unique_id", F.filter(listed, lambda x: x["bits"] != 0).alias("months"))


def customer_months(customers: DataFrame, orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """customer_unique_id, months: a bitmap of the months with any order, in words of 62 months that aren't empty.

    With ``state``, an earlier result, only new orders need be given; months that are in both change
    nothing. A customer is one row in the one shuffle by customer, whatever the number of orders.
    """
    timed = orders.where(F.col("order_purchase_timestamp").isNotNull())
    number = _month_number("order_purchase_timestamp")
    ends = timed.agg(F.min(F.floor(number / WORD)).alias("lo"), F.max(F.floor(number / WORD)).alias("hi"))
    if state is not None:
        words = state.select(F.explode("months.word").alias("w"))
        ends = ends.unionAll(words.agg(F.min("w"), F.max("w"))).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lo, hi = ends.first()
    lo, hi = (0, 0) if lo is None else (int(lo), int(hi))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % WORD).cast("int"))
    bits = customer_orders(customers, timed).select(
        "customer_unique_id", F.floor(number / WORD).cast("int").alias("word"), bit.alias("bits")
    )
    if state is not None:
        bits = bits.unionByName(state.select("customer_unique_id", F.inline("months")))
    return _merged(bits, lo, hi)


def cohorts_of_months(months: DataFrame) -> DataFrame:
    """The cohort table from customers' bitmaps of months."""
    places = lambda x: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit(x["bits"], b) == 1),
        lambda b: x["word"] * WORD + b,
    )
    listed = months.select(F.flatten(F.transform("months", places)).alias("numbers"))
    each = listed.select(F.array_min("numbers").alias("first"), F.explode("numbers").alias("number"))
    counted = each.groupBy("first", "number").agg(F.count(F.lit(1)).alias("unique_customers"))
    start = lambda c: F.make_date(F.floor(F.col(c) / 12).cast("int"), F.col(c) % 12 + 1, F.lit(1))
    return counted.select(
        start("first").alias("cohort_group"),
        start("number").alias("order_month"),
        "unique_customers",
        (F.col("number") - F.col("first")).alias("cohort_period"),
    )


def cohorts(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct customers per month of first order and month of order. All orders count."""
    return cohorts_of_months(customer_months(customers, orders))


def cohort_retention(table: DataFrame) -> DataFrame:
    """Add cohort size (customers of period 0) and the share that ordered again in each period."""
    start = F.when(F.col("cohort_period") == 0, F.col("unique_customers"))
    size = F.max(start).over(W.partitionBy("cohort_group"))
    return table.withColumn("cohort_size", size).withColumn(
        "retention", ratio("unique_customers", "cohort_size")
    )


def best_cohorts(
    retention: DataFrame, period: int = 3, n: int = 2, year: int | None = None
) -> DataFrame:
    """The ``n`` cohorts, of all or of one year, with the highest retention in a period."""
    rows = retention.where(F.col("cohort_period") == period)
    if year is not None:
        rows = rows.where(F.year("cohort_group") == year)
    return (
        rows.select("cohort_group", "cohort_size", "unique_customers", "retention")
        .orderBy(F.desc("retention"), "cohort_group")
        .limit(n)
    )


def cohort_matrix(
    table: DataFrame, periods: Sequence[int] | None = None, value: str = "unique_customers"
) -> DataFrame:
    """One row per cohort, one column per period.

    When no periods are given, Spark looks them up before it pivots. The table, at most one row
    per pair of months, is staged for that, so the orders are read once.
    """
    if periods is None:
        wide = stage(table, "cohorts").groupBy("cohort_group").pivot("cohort_period")
    else:
        wide = table.groupBy("cohort_group").pivot("cohort_period", list(periods))
    return wide.agg(F.avg(value)).orderBy("cohort_group")
