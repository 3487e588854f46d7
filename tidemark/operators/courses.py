"""Student activity and the payment funnel of an experiment on course pages.

``peas``: st_id, timest, correct, subject. ``studs``: st_id, test_grp.
``checks``: st_id, sale_time, money, subject.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import money_sum, ratio, zero_sum


def solved() -> Column:
    return F.col("correct").cast("int") == 1


def in_math() -> Column:
    return F.col("subject") == "Math"


def diligent_students(peas: DataFrame, month: dt.date | str, at_least: int = 20) -> DataFrame:
    """One row: students with at least ``at_least`` correct tasks in the calendar month.

    ``month`` is any day of it, as a date or as text (yyyy-MM-dd), which Spark casts. The limits are constants, so
    they reach the file scan.
    """
    kind = peas.schema["timest"].dataType
    start = F.trunc(F.lit(month).cast("date"), "MM")
    inside = (F.col("timest") >= start.cast(kind)) & (F.col("timest") < F.add_months(start, 1).cast(kind))
    return (
        peas.where(inside)
        .where(solved())
        .groupBy("st_id")
        .agg(F.count(F.lit(1)).alias("solved"))
        .where(F.col("solved") >= at_least)
        .agg(F.count("st_id").alias("count_students"))
    )


def funnel_metrics(
    studs: DataFrame,
    peas: DataFrame,
    checks: DataFrame,
    active_over: int = 10,
    math_at_least: int = 2,
) -> DataFrame:
    """Revenue and purchase ratios per test group.

    Tasks and purchases are each added up per student in one pass, whatever the subject, and
    meet the students on the same key; a student with very many tasks is one row by then.
    A student listed several times in a group counts that often, as the rows would.
    """
    tasks = (
        peas.where(solved())
        .groupBy("st_id")
        .agg(F.count(F.lit(1)).alias("solved"), F.count_if(in_math()).alias("solved_math"))
    )
    bought = checks.groupBy("st_id").agg(
        money_sum("money").alias("money"),
        F.count("st_id").alias("sales"),
        F.count_if(in_math()).alias("sales_math"),
    )
    members = studs.groupBy("st_id", "test_grp").agg(F.count(F.lit(1)).alias("times"))
    times = F.col("times")
    return (
        members.join(tasks, "st_id", "left")
        .join(bought, "st_id", "left")
        .where(F.col("test_grp").isNotNull())
        .groupBy("test_grp")
        .agg(
            F.sum(times).alias("students"),
            F.count_if(F.col("solved") * times > active_over).alias("active"),
            F.count_if(F.col("solved_math") * times >= math_at_least).alias("active_math"),
            money_sum(F.col("money") * times).alias("revenue"),
            zero_sum(F.col("sales") * times).alias("sales"),
            zero_sum(F.col("sales_math") * times).alias("sales_math"),
        )
        .select(
            "test_grp",
            ratio("revenue", "students").alias("ARPU"),
            ratio("revenue", "active").alias("ARPAU"),
            ratio("sales", "students").alias("CR_buy"),
            ratio("sales", "active").alias("CR_active_buy"),
            ratio("sales_math", "active_math").alias("CR_active_buy_math"),
        )
    )
