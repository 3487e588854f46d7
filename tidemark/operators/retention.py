"""App retention: how many users who started on a day are active on each later day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import days_before, time_range
from tidemark.session import path_exists

MASK_DAYS = 62


def app_retention(
    feed: DataFrame, messages: DataFrame, as_of: dt.date, days: int = 7
) -> DataFrame:
    """Users per (start_day, day) for users whose first activity ever is in the last ``days`` days.

    The day of the run itself counts, as far as it has gone; what lies after it does not.

    First activity needs the whole history, but later activity matters only inside the window.
    One pass keeps, per user, the first day and a bit per active day of the window, in masks of
    62 days each, so a user is 16 bytes in the only large shuffle (for up to 61 days), whatever the
    number of events.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    first_day = days_before(as_of, days)
    end = days_before(as_of, -1)
    history = time_range(feed.select("user_id", "time"), "time", None, end).unionByName(
        time_range(messages.select("user_id", "time"), "time", None, end)
    )
    day = F.to_date("time")
    place = F.date_diff(day, F.lit(first_day))
    one = F.lit(1).cast("bigint")
    masks = [
        F.bit_or(
            F.when(
                place.between(start, start + MASK_DAYS - 1), F.call_function("shiftleft", one, place - start)
            ).otherwise(0)
        ).alias(f"active{i}")
        for i, start in enumerate(range(0, days + 1, MASK_DAYS))
    ]
    users = (
        history.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(day).alias("start_day"), *masks)
        .where(F.col("start_day") >= F.lit(first_day))
        .select("start_day", F.array(*[f"active{i}" for i in range(len(masks))]).alias("active"))
    )
    places = F.explode(F.sequence(F.lit(0), F.lit(days))).alias("place")
    return (
        users.select("start_day", "active", places)
        .where(
            F.getbit(F.get("active", F.floor(F.col("place") / MASK_DAYS).cast("int")), F.col("place") % MASK_DAYS)
            == 1
        )
        .groupBy("start_day", F.date_add(F.lit(first_day), F.col("place")).alias("day"))
        .agg(F.count(F.lit(1)).alias("users"))
    )


# the same with kept state: one row per user, read instead of the history

#: Days that a user's mask holds, the day of the state included.
STATE_DAYS = 62


def _activity(feed: DataFrame, messages: DataFrame, start: dt.date | None, as_of: dt.date) -> DataFrame:
    """user_id, first_day, active: bit k of ``active`` is set if the user was active k days before ``as_of``."""
    end = days_before(as_of, -1)
    events = time_range(feed.select("user_id", "time"), "time", start, end).unionByName(
        time_range(messages.select("user_id", "time"), "time", start, end)
    )
    day = F.to_date("time")
    back = F.date_diff(F.lit(as_of), day)
    bit = F.when(back < STATE_DAYS, F.call_function("shiftleft", F.lit(1).cast("bigint"), back)).otherwise(0)
    known = events.where(F.col("user_id").isNotNull() & F.col("time").isNotNull())
    return known.groupBy("user_id").agg(F.min(day).alias("first_day"), F.bit_or(bit).alias("active"))


def retention_state(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    """The state after ``as_of`` from the whole history: needed once."""
    return _activity(feed, messages, None, as_of)


def next_state(
    state: DataFrame, feed: DataFrame, messages: DataFrame, as_of: dt.date, reread_days: int = 1
) -> DataFrame:
    """``state`` of the day before ``as_of``, moved on by one day.

    Reads the events of the last ``reread_days`` days: setting a bit again changes nothing, so a longer stretch
    only takes in events that came late. A user is 20 bytes in the one shuffle.
    """
    kept = F.call_function("shiftleft", F.col("active"), F.lit(1)).bitwiseAND(F.lit((1 << STATE_DAYS) - 1))
    older = state.select("user_id", "first_day", kept.alias("active"))
    newer = _activity(feed, messages, days_before(as_of, reread_days - 1), as_of)
    both = older.unionByName(newer)
    return both.groupBy("user_id").agg(F.min("first_day").alias("first_day"), F.bit_or("active").alias("active"))


def advance_state(
    spark: SparkSession, path: str, feed: DataFrame, messages: DataFrame, as_of: dt.date, reread_days: int = 1
) -> DataFrame:
    """The state of ``as_of``, written under ``path`` from that of the day before, or from the history if
    there is none. A repeated run replaces the day."""
    place = lambda day: f"{path}/as_of={day.isoformat()}"
    schema = _activity(feed, messages, as_of, as_of).schema
    if path_exists(spark, place(days_before(as_of, 1)) + "/_SUCCESS"):
        old = spark.read.schema(schema).parquet(place(days_before(as_of, 1)))
        state = next_state(old, feed, messages, as_of, reread_days)
    else:
        state = retention_state(feed, messages, as_of)
    state.write.mode("overwrite").parquet(place(as_of))
    return spark.read.schema(schema).parquet(place(as_of))


def retention_of_state(state: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """``app_retention`` from the state of ``as_of``, without any event."""
    if not 1 <= days < STATE_DAYS:
        raise ValueError(f"days must be from 1 to {STATE_DAYS - 1}")
    started = state.where(F.col("first_day") >= F.lit(days_before(as_of, days)))
    each = started.select("first_day", "active", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("back"))
    return (
        each.where(F.getbit("active", F.col("back")) == 1)
        .groupBy(F.col("first_day").alias("start_day"), F.date_sub(F.lit(as_of), F.col("back")).alias("day"))
        .agg(F.count(F.lit(1)).alias("users"))
    )


def retention_matrix(retention: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """One row per start day, one column per day of the window (named yyyy-MM-dd)."""
    shown = [days_before(as_of, back).isoformat() for back in range(days, -1, -1)]
    return (
        retention.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        .groupBy("start_day")
        .pivot("day", shown)
        .agg(F.avg("users"))
        .orderBy("start_day")
    )
