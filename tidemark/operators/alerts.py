"""Fifteen-minute metrics and their check against bands from the preceding buckets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions.exprs import days_before, quarter_hour, ratio, round_even, time_range
from tidemark.operators.activity import is_like, is_view

FEED_METRICS = ["users_feed", "views", "likes", "ctr"]
MESSAGE_METRICS = ["users_message", "messages"]

# fixed value: the text sent with an alert (metric, value, change in percent)
ALERT_TEXT = "Метрика %s:\nтекущее значение %s\nотклонение от предыдущего значения %s"


def floor_quarter(now: dt.datetime) -> dt.datetime:
    return now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0)


def _closed_buckets(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Yesterday and today, without the quarter of an hour that is still running."""
    recent = time_range(df, "time", days_before(now.date(), 1), floor_quarter(now))
    return recent.withColumn("ts", quarter_hour("time"))


def label_buckets(buckets: DataFrame) -> DataFrame:
    """Add the date and the HH:mm label of each bucket."""
    rest = [c for c in buckets.columns if c != "ts"]
    return buckets.select(
        "ts", F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm").alias("hm"), *rest
    )


def count_feed(events: DataFrame) -> DataFrame:
    """Users, likes, views and ctr per ``ts``, the bucket that each event is marked with."""
    seen = F.col("user_id").isNotNull()
    counted = events.groupBy("ts").agg(
        F.count_distinct("user_id").alias("users_feed"),
        F.count_if(seen & is_like()).alias("likes"),
        F.count_if(seen & is_view()).alias("views"),
    )
    return label_buckets(counted.withColumn("ctr", round_even(ratio("likes", "views"), 3)))


def count_messages(events: DataFrame) -> DataFrame:
    """Users and messages per ``ts``, the bucket that each event is marked with."""
    counted = events.groupBy("ts").agg(
        F.count_distinct("user_id").alias("users_message"), F.count("user_id").alias("messages")
    )
    return label_buckets(counted)


def feed_buckets(feed: DataFrame, now: dt.datetime) -> DataFrame:
    """Users, likes, views and ctr per closed bucket since yesterday's midnight."""
    return count_feed(_closed_buckets(feed, now))


def message_buckets(messages: DataFrame, now: dt.datetime) -> DataFrame:
    """Users and messages per closed bucket since yesterday's midnight."""
    return count_messages(_closed_buckets(messages, now))


def fill_gaps(buckets: DataFrame) -> DataFrame:
    """Add the buckets in which nothing happened, with null metrics."""
    span = buckets.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    every = span.select(F.explode(F.expr("sequence(lo, hi, INTERVAL 15 MINUTES)")).alias("ts"))
    metrics = [c for c in buckets.columns if c not in ("ts", "date", "hm")]
    return label_buckets(every.join(buckets.select("ts", *metrics), "ts", "left"))


def anomaly_bands(
    buckets: DataFrame,
    metrics: Sequence[str],
    a: float = 4,
    n: int = 5,
    edge: str = "shrink",
) -> DataFrame:
    """Bands per metric: quartiles of the ``n`` rows before, widened by ``a`` times their distance.

    The bounds are smoothed by a centred mean over ``n`` rows. ``edge="strict"`` asks for all
    ``n`` bounds, which leaves the last rows without a band; ``"shrink"`` averages those there are.

    The frames count rows, not time. All metrics run side by side; a partition holds one
    metric's buckets, 96 a day, not events.
    """
    if edge not in ("shrink", "strict"):
        raise ValueError("edge must be 'shrink' or 'strict'")
    values = [F.col(name).cast("double").alias(name) for name in metrics]
    long = buckets.select("ts", *values).unpivot("ts", list(metrics), "metric", "value")
    line = W.partitionBy("metric").orderBy("ts")
    earlier = line.rowsBetween(-n, -1)
    after = (n - 1) // 2
    around = line.rowsBetween(after + 1 - n, after)
    full = F.count("value").over(earlier) == n
    needed = n if edge == "strict" else 1

    def smooth(bound: str):
        return F.when(F.count(bound).over(around) >= needed, F.avg(bound).over(around))

    return (
        long.withColumns(
            {
                "previous": F.lag("value").over(line),
                "q25": F.when(full, F.percentile("value", 0.25).over(earlier)),
                "q75": F.when(full, F.percentile("value", 0.75).over(earlier)),
            }
        )
        .withColumn("iqr", F.col("q75") - F.col("q25"))
        .withColumns(
            {"high": F.col("q75") + a * F.col("iqr"), "low": F.col("q25") - a * F.col("iqr")}
        )
        .withColumns({"high": smooth("high"), "low": smooth("low")})
    )


def _two_places(number: Column, unit: str = "") -> Column:
    shown = F.concat(F.format_string("%.2f", round_even(number, 2)), F.lit(unit))
    return F.when(number.isNull(), F.lit("-")).otherwise(shown)


def latest_checks(bands: DataFrame) -> DataFrame:
    """The newest row of each metric: value, band, change from the row before, alert or not."""
    newest = F.max("ts").over(W.partitionBy("metric"))
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    change = 1 - ratio("value", "previous")
    text = F.format_string(
        ALERT_TEXT, F.col("metric"), _two_places(F.col("value")), _two_places(change * 100, "%")
    )
    return (
        bands.withColumn("newest", newest)
        .where(F.col("ts") == F.col("newest"))
        .select(
            "metric",
            "ts",
            "value",
            "previous",
            "low",
            "high",
            change.alias("change"),
            F.coalesce(outside, F.lit(False)).alias("is_alert"),
            text.alias("text"),
        )
    )


def alerts(bands: DataFrame) -> DataFrame:
    """The rows of ``latest_checks`` that call for a message."""
    return latest_checks(bands).where("is_alert")
