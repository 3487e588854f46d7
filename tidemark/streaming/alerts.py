"""Fifteen-minute metrics on a stream of events, and the band check over what it has written."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemark.functions.exprs import quarter_hour, ratio, round_even, time_range
from tidemark.operators.activity import is_like, is_view
from tidemark.operators.alerts import anomaly_bands, floor_quarter, latest_checks

BUCKET = "15 minutes"


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they arrive in a folder, oldest first.

    ``files_per_batch`` keeps a backlog from becoming one large batch.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _per_user(events: DataFrame, lateness: str, **counts) -> DataFrame:
    """One row per bucket and user. Streams cannot count distinct values, but they can group.

    State is keyed by bucket and user, so a bucket with very many users is spread over all tasks.
    """
    return (
        events.withColumn("time", F.col("time").cast("timestamp"))
        .where(F.col("user_id").isNotNull())
        .withWatermark("time", lateness)
        .groupBy(F.window("time", BUCKET), "user_id")
        .agg(*[c.alias(name) for name, c in counts.items()])
    )


def _per_bucket(users: DataFrame, counted: str, sums: Sequence[str]) -> DataFrame:
    again = F.window(F.window_time("window"), BUCKET)
    return users.groupBy(again.alias("bucket")).agg(
        F.count("user_id").alias(counted), *[F.sum(name).alias(name) for name in sums]
    )


def _labelled(buckets: DataFrame, *metrics) -> DataFrame:
    ts = F.col("bucket.start")
    return buckets.select(
        ts.alias("ts"), F.to_date(ts).alias("date"), F.date_format(ts, "HH:mm").alias("hm"), *metrics
    )


def feed_bucket_stream(feed: DataFrame, lateness: str) -> DataFrame:
    """Users, likes, views and ctr of each bucket, once the watermark has passed its end.

    Events later than ``lateness`` behind the newest one are not counted; ``recount_touched_buckets`` counts
    all, whenever they come.
    """
    users = _per_user(feed, lateness, likes=F.count_if(is_like()), views=F.count_if(is_view()))
    buckets = _per_bucket(users, "users_feed", ["likes", "views"])
    ctr = round_even(ratio("likes", "views"), 3).alias("ctr")
    return _labelled(buckets, "users_feed", "likes", "views", ctr)


def message_bucket_stream(messages: DataFrame, lateness: str) -> DataFrame:
    """Users and messages of each bucket, once the watermark has passed its end."""
    users = _per_user(messages, lateness, messages=F.count(F.lit(1)))
    return _labelled(_per_bucket(users, "users_message", ["messages"]), "users_message", "messages")


def append_closed_buckets(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append closed buckets to the table at ``path``, partitioned by date.

    Without ``every``, processes what there is and stops. A restart goes on from ``checkpoint``.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


#: Separate stretches of time that one read of the event table asks for.
STRETCHES = 64


def _in_touched_days(events: DataFrame, touched: DataFrame) -> DataFrame:
    """Events in the stretches of time that ``touched`` buckets span, day by day, as ranges of the bare column.

    The driver sees one row a day. With more than STRETCHES days it asks for everything between the ends.
    """
    day = touched.groupBy(F.to_date("ts")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    days = sorted((r["lo"], r["hi"] + dt.timedelta(minutes=15)) for r in day.collect())
    if len(days) > STRETCHES:
        days = [(days[0][0], days[-1][1])]
    kind = events.schema["time"].dataType
    at = lambda moment: F.lit(moment.isoformat(sep=" ")).cast(kind)
    inside = [(F.col("time") >= at(lo)) & (F.col("time") < at(hi)) for lo, hi in days]
    return events.where(functools.reduce(Column.__or__, inside, F.lit(False)))


def recount_touched_buckets(
    arrivals: DataFrame,
    table: Callable[[], DataFrame],
    counted: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the buckets at ``path`` right however late events come.

    ``arrivals`` is the stream of new events, ``table`` reads the event table they are part of, ``counted`` is
    ``count_feed`` or ``count_messages``. Each batch finds the buckets its events fall into, recounts just
    those from the table, and writes them as a version of its own, which a repeated batch
    replaces. ``current_buckets`` shows the newest version of each bucket. There is no lateness beyond which
    an event is lost, and no state that grows with users. Events without a time are left out.
    """

    def recount(batch: DataFrame, number: int) -> None:
        timed = batch.where(F.col("time").isNotNull())
        touched = timed.select(quarter_hour("time").alias("ts")).distinct().persist()
        try:
            events = _in_touched_days(table(), touched).withColumn("ts", quarter_hour("time"))
            found = counted(events.join(touched, "ts", "left_semi"))
            found.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(f"{path}/version={number}")
        finally:
            touched.unpersist()

    writer = arrivals.writeStream.foreachBatch(recount).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def current_buckets(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The newest version of each bucket, of all days or from ``since`` on."""
    versions = spark.read.option("basePath", path).parquet(f"{path}/version=*")
    if since:
        versions = versions.where(F.col("date") >= F.lit(since))
    metrics = [c for c in versions.columns if c not in ("ts", "version")]
    newest = F.max_by(F.struct(*metrics), "version").alias("row")
    return versions.groupBy("ts").agg(newest).select("ts", "row.date", "row.hm", *[f"row.{c}" for c in metrics if c not in ("date", "hm")])


def check_written_buckets(
    buckets: DataFrame,
    metrics: Sequence[str],
    now: dt.datetime,
    a: float = 4,
    n: int = 5,
    edge: str = "shrink",
) -> DataFrame:
    """Newest row of each metric against its band, from the buckets a stream has written.

    A band of the newest row needs ``n`` rows for the quartiles, half as many again for the
    smoothing and the row itself; reading the table back from yesterday's midnight is plenty, and
    prunes all other dates.
    """
    since = now.date() - dt.timedelta(days=1)
    recent = buckets.where(F.col("date") >= F.lit(since))
    recent = time_range(recent, "ts", None, floor_quarter(now))
    return latest_checks(anomaly_bands(recent, metrics, a, n, edge))


# the band check as a stateful operator: an alert leaves with the bucket that causes it

CHECKED = "metric string, ts timestamp, value double, previous double, low double, high double, change double, is_alert boolean"


class BandCheck(StatefulProcessor):
    """Keeps the last buckets of a metric, as many as the newest one's band depends on.

    The bounds of a row are quartiles of the ``n`` rows before it, widened by ``a`` times their distance, and are
    averaged over the row and the (n - 1) // 2 before it, as ``anomaly_bands(edge="shrink")`` does for a newest row.
    """

    def __init__(self, a: float, n: int):
        self.a, self.n = a, n

    def init(self, handle) -> None:
        self.kept = handle.getValueState("kept", "ts array<timestamp>, value array<double>")

    def handleInputRows(self, key, rows, timerValues):
        around = (self.n - 1) // 2
        ts, values = [], []
        if self.kept.exists():
            ts, values = (list(x) for x in self.kept.get())
        new = pd.concat(list(rows)).sort_values("ts")
        out = []
        for at, value in zip(new["ts"], new["value"].astype(float)):
            if ts and pd.Timestamp(at) <= pd.Timestamp(ts[-1]):
                continue
            ts.append(at)
            values.append(value)
            seen = np.array(values, dtype=float)
            lows, highs = [], []
            for last in range(max(0, len(seen) - 1 - around), len(seen)):
                before = seen[max(0, last - self.n) : last]
                if len(before) == self.n and not np.isnan(before).any():
                    q25, q75 = np.quantile(before, [0.25, 0.75])
                    lows.append(q25 - self.a * (q75 - q25))
                    highs.append(q75 + self.a * (q75 - q25))
            low, high = (float(np.mean(x)) if x else None for x in (lows, highs))
            previous = seen[-2] if len(seen) > 1 else np.nan
            change = 1 - value / previous if previous else np.nan
            out.append((key[0], at, value, previous, low, high, change, bool(lows) and bool(value < low or value > high)))
            ts, values = ts[-self.n - around - 1 :], values[-self.n - around - 1 :]
        if ts:
            self.kept.update((ts, values))
        yield pd.DataFrame(out, columns=["metric", "ts", "value", "previous", "low", "high", "change", "is_alert"])

    def close(self) -> None:
        pass


def check_bucket_stream(buckets: DataFrame, metrics: Sequence[str], a: float = 4, n: int = 5) -> DataFrame:
    """Every bucket of a stream of closed buckets against its band, for each metric, as soon as it comes.

    Nothing is read again: the state is the last ``n + (n - 1) // 2 + 1`` buckets of a metric (8). Buckets have to
    come in time order from batch to batch, in any order inside one; one that is not newer than those already
    seen is left out. Needs the RocksDB state store.
    """
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    long = buckets.select(F.col("ts").cast("timestamp").alias("ts"), *values).unpivot("ts", list(metrics), "metric", "value")
    return long.groupBy("metric").transformWithStateInPandas(
        statefulProcessor=BandCheck(a, n), outputStructType=CHECKED, outputMode="append", timeMode="None"
    )


def append_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream gives to the Parquet files at ``path``: all there is, then stop."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
