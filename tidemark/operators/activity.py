"""Daily activity in the feed and the messenger.

``feed``: user_id, time, action ('like' or 'view'), gender, age, os, source.
``messages``: user_id, reciever_id, time, gender, age, os, source.
``as_of`` is the day the job runs; "yesterday" is the day before it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import days_before, ratio, round_even, time_range, zero_sum

ATTRIBUTES = ["gender", "age", "os"]
USER_DAY = ["user_id", "event_date", *ATTRIBUTES]
SLICE_METRICS = [
    "views",
    "likes",
    "messages_received",
    "messages_sent",
    "users_received",
    "users_sent",
]


def is_like() -> Column:
    return F.col("action") == "like"


def is_view() -> Column:
    return F.col("action") == "view"


def _yesterday(df: DataFrame, as_of: dt.date) -> DataFrame:
    return time_range(df, "time", days_before(as_of, 1), as_of)


def _distinct(column: str, exact: bool) -> Column:
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def feed_user_daily(feed: DataFrame, as_of: dt.date) -> DataFrame:
    """Yesterday's likes and views per user and attributes."""
    return (
        _yesterday(feed, as_of)
        .groupBy("user_id", F.to_date("time").alias("event_date"), *ATTRIBUTES)
        .agg(F.count_if(is_like()).alias("likes"), F.count_if(is_view()).alias("views"))
    )


def message_user_daily(
    messages: DataFrame, feed_daily: DataFrame, as_of: dt.date, literal: bool = False
) -> DataFrame:
    """Yesterday's messages sent and received per user, and with how many people.

    Both sides are reduced to one row per user before they meet, so a user with very many
    messages is spread over all tasks. What a user received is counted once: on the set of attributes with
    which the user sent most that day or, for one who sent nothing, was most active in the feed (ties: the
    largest values), or on none.

    ``literal=True`` reproduces the published job: it drops users who only received, repeats the
    received counts for each set of attributes of a sender, and reports 1 for ``users_received``.
    """
    day = _yesterday(messages, as_of)
    sent = day.groupBy("user_id", F.to_date("time").alias("event_date"), *ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("messages_sent"),
        F.count_distinct("reciever_id").alias("users_sent"),
    )
    senders = F.lit(1).cast("bigint") if literal else F.count_distinct("sender")
    received = (
        day.select(F.col("reciever_id").alias("user_id"), F.col("user_id").alias("sender"), "time")
        .groupBy("user_id", F.to_date("time").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("messages_received"), senders.alias("users_received"))
    )
    counts = ["messages_sent", "messages_received", "users_sent", "users_received"]
    key = ["user_id", "event_date"]
    if literal:
        return sent.join(received, key, "left").select(*USER_DAY, *counts)

    # the set of attributes that carries what the user received
    own = sent.select(*USER_DAY, F.lit(1).alias("own"), F.col("messages_sent").alias("n"))
    seen = feed_daily.select(*USER_DAY, F.lit(0).alias("own"), (F.col("likes") + F.col("views")).alias("n"))
    home = own.union(seen).groupBy(*key).agg(F.max(F.struct("own", "n", *ATTRIBUTES)).alias("home"))
    attributes = [F.col(f"home.{name}").alias(name) for name in ATTRIBUTES]
    at_home = received.join(home, key, "left").select(
        *key, *attributes, "messages_received", "users_received"
    )
    return combine_actions(sent, at_home).select(*USER_DAY, *counts)


def combine_actions(feed_daily: DataFrame, message_daily: DataFrame) -> DataFrame:
    """Outer merge on user, day and attributes, where a missing attribute equals a missing one.

    Each side has one row per key, so stacking and grouping gives the merge with one shuffle;
    grouping treats nulls as equal, which a join does not.
    """
    metrics = [c for c in (*feed_daily.columns, *message_daily.columns) if c not in USER_DAY]
    return (
        feed_daily.unionByName(message_daily, allowMissingColumns=True)
        .groupBy(*USER_DAY)
        .agg(*[F.max(name).alias(name) for name in metrics])
    )


def daily_slices(combined: DataFrame, dimensions: Sequence[str] = ("gender", "os", "age")) -> DataFrame:
    """Sums of the user metrics by each dimension, stacked. Rows without a value are left out."""
    long = combined.select(
        "event_date", *SLICE_METRICS, *[F.col(name).cast("string") for name in dimensions]
    ).unpivot(["event_date", *SLICE_METRICS], list(dimensions), "dimension", "dimension_value")
    return (
        long.where(F.col("dimension_value").isNotNull())
        .groupBy("event_date", "dimension", "dimension_value")
        .agg(*[zero_sum(name).cast("double").alias(name) for name in SLICE_METRICS])
    )


def daily_summary(
    feed: DataFrame, messages: DataFrame, as_of: dt.date, exact: bool = True
) -> DataFrame:
    """Yesterday in one row: likes, views, ctr, messages, dau. One pass over each table."""
    acts = _yesterday(feed, as_of).select(
        "user_id", is_like().alias("is_like"), is_view().alias("is_view"), F.lit(False).alias("is_message")
    )
    sent = _yesterday(messages, as_of).select(
        "user_id",
        F.lit(False).alias("is_like"),
        F.lit(False).alias("is_view"),
        F.col("user_id").isNotNull().alias("is_message"),
    )
    return (
        acts.unionByName(sent)
        .agg(
            F.count_if("is_like").alias("likes"),
            F.count_if("is_view").alias("views"),
            F.count_if("is_message").alias("messages"),
            _distinct("user_id", exact).alias("dau"),
        )
        .select(
            F.lit(days_before(as_of, 1)).alias("date"),
            "likes",
            "views",
            round_even(ratio("likes", "views"), 3).alias("ctr"),
            "messages",
            "dau",
        )
    )


def feed_series(feed: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Views, likes and ctr for each of the ``days`` days before ``as_of``."""
    return (
        time_range(feed, "time", days_before(as_of, days), as_of)
        .groupBy(F.to_date("time").alias("date"))
        .agg(F.count_if(is_view()).alias("views"), F.count_if(is_like()).alias("likes"))
        .withColumn("ctr", round_even(ratio("likes", "views"), 3))
        .orderBy("date")
    )


def message_series(messages: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Messages sent on each of the ``days`` days before ``as_of``."""
    return (
        time_range(messages, "time", days_before(as_of, days), as_of)
        .groupBy(F.to_date("time").alias("date"))
        .agg(F.count("user_id").alias("messages"))
        .orderBy("date")
    )


def active_users(
    feed: DataFrame,
    messages: DataFrame,
    as_of: dt.date,
    days: int = 1,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Distinct users of feed or messenger per day, optionally by columns such as ``source``."""
    columns = ["user_id", "time", *by]
    return (
        time_range(feed.select(*columns), "time", days_before(as_of, days), as_of)
        .unionByName(
            time_range(messages.select(*columns), "time", days_before(as_of, days), as_of)
        )
        .groupBy(F.to_date("time").alias("date"), *by)
        .agg(_distinct("user_id", exact).alias("unique_users"))
        .orderBy("date", *by)
    )


# distinct users of any stretch of days, from one sketch a day

#: log2 of a sketch's cells, and what an estimate may be off by: three standard errors.
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_sketches(
    feed: DataFrame, messages: DataFrame, as_of: dt.date, days: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """date, by.., users: a mergeable sketch of the day's distinct users of feed or messenger.

    To be stored: a day costs some 16 KB for each set of attributes, whatever its number of events.
    """
    columns = ["user_id", "time", *by]
    span = (days_before(as_of, days), as_of)
    both = time_range(feed.select(*columns), "time", *span).unionByName(
        time_range(messages.select(*columns), "time", *span)
    )
    users = F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("users")
    return both.where(F.col("user_id").isNotNull()).groupBy(F.to_date("time").alias("date"), *by).agg(users)


def users_of_sketches(sketches: DataFrame, as_of: dt.date, days: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """by.., estimated_users: distinct users of the ``days`` days before ``as_of``, from stored sketches.

    Users of several days or attributes count once. Off by SKETCH_ERROR as a share at most, but in one of some
    three hundred cases.
    """
    inside = sketches.where((F.col("date") >= F.lit(days_before(as_of, days))) & (F.col("date") < F.lit(as_of)))
    union = F.hll_union_agg("users")
    return inside.groupBy(*by).agg(F.hll_sketch_estimate(union).alias("estimated_users"))
