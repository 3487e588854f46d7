"""Bands and alerts against their definition, batch and stream."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import alerts
from tidemark.plans import jobs
from tidemark.sources.fixtures import NOW, VIEWS, view
from tidemark.streaming import alerts as streams

SF_DIR = "/root/testdata/sf0.01"
START = dt.datetime(2024, 1, 1)


def buckets(spark, values):
    made = [(START + i * dt.timedelta(minutes=15), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(made, "ts timestamp, m double")


def plain_bands(values, a=4, n=5, strict=False):
    """(low, high) of each place, from the definition: a loop over places."""
    raw = []
    for i in range(len(values)):
        if i < n:
            raw.append(None)
            continue
        q25, q75 = np.quantile(values[i - n : i], [0.25, 0.75])
        raw.append((q25 - a * (q75 - q25), q75 + a * (q75 - q25)))
    smooth = []
    for i in range(len(values)):
        after = (n - 1) // 2
        around = [raw[k] for k in range(i + after + 1 - n, i + after + 1) if 0 <= k < len(raw) and raw[k]]
        enough = len(around) >= (n if strict else 1)
        smooth.append(tuple(sum(x) / len(around) for x in zip(*around)) if enough else (None, None))
    return [x[0] for x in smooth], [x[1] for x in smooth]


@pytest.mark.parametrize("edge", ["shrink", "strict"])
@pytest.mark.parametrize("n", [4, 5])
def test_bands_equal_plain(spark, edge, n):
    values = [(i * 37) % 11 + (i % 3) * 0.5 for i in range(60)]
    low, high = plain_bands(values, n=n, strict=edge == "strict")
    got = rows(alerts.anomaly_bands(buckets(spark, values), ["m"], n=n, edge=edge), "ts")
    names = alerts.anomaly_bands(buckets(spark, values), ["m"], n=n).columns
    for i, row in enumerate(got):
        row = dict(zip(names, row))
        for name, wanted in (("low", low[i]), ("high", high[i])):
            assert (row[name] is None) == (wanted is None)
            if row[name] is not None:
                assert row[name] == pytest.approx(wanted)


def test_a_spike_is_flagged_only_with_the_shrinking_edge(spark):
    df = buckets(spark, [*range(29), 1_000_000])
    assert alerts.alerts(alerts.anomaly_bands(df, ["m"])).count() == 1
    assert alerts.alerts(alerts.anomaly_bands(df, ["m"], edge="strict")).count() == 0


def test_unknown_edge(spark):
    with pytest.raises(ValueError):
        alerts.anomaly_bands(buckets(spark, [1]), ["m"], edge="none")


def test_alert_text(spark):
    got = alerts.latest_checks(alerts.anomaly_bands(buckets(spark, [0.4, 0.575]), ["m"])).first()
    assert got.text.split("\n") == [
        "Метрика m:",
        f"текущее значение {0.575:.2f}",
        f"отклонение от предыдущего значения {1 - 0.575 / 0.4:.2%}",
    ]
    assert got.is_alert is False


def test_text_without_values(spark):
    df = spark.createDataFrame(
        [(START, 0.0), (START + dt.timedelta(hours=1), None)], "ts timestamp, m double"
    )
    got = alerts.latest_checks(alerts.anomaly_bands(df, ["m"])).first()
    assert "текущее значение -" in got.text and got.text.endswith("значения -")


def test_rows_not_time(spark):
    df = spark.createDataFrame(
        [(START, 4.0), (START + dt.timedelta(hours=1), 5.0)], "ts timestamp, m double"
    )
    got = alerts.latest_checks(alerts.anomaly_bands(df, ["m"])).first()
    assert (got.value, got.previous) == (5.0, 4.0)
    filled = alerts.fill_gaps(alerts.label_buckets(df))
    assert [r.hm for r in filled.collect()] == ["00:00", "00:15", "00:30", "00:45", "01:00"]
    assert [r.m for r in filled.collect()] == [4.0, None, None, None, 5.0]


def test_zero_views_give_no_ctr(spark):
    feed = spark.createDataFrame([(1, NOW - dt.timedelta(hours=1), "like")], "user_id long, time timestamp, action string")
    got = alerts.feed_buckets(feed, NOW).first()
    assert (got.users_feed, got.likes, got.views, got.ctr) == (1, 1, 0, None)


def test_the_running_quarter_is_left_out(spark):
    times = [NOW.replace(minute=0), NOW.replace(minute=0) - dt.timedelta(seconds=1)]
    feed = spark.createDataFrame([(1, t, "view") for t in times], "user_id long, time timestamp, action string")
    assert [r.hm for r in alerts.feed_buckets(feed, NOW).collect()] == ["17:45"]


def test_job_reports_a_spike(spark):
    feed = view(spark, SF_DIR, "feed_actions")
    crowd = spark.range(500).select(
        F.col("id").alias("user_id"),
        F.lit(NOW - dt.timedelta(minutes=10)).cast("timestamp_ntz").alias("time"),
        F.lit("view").alias("action"),
    )
    both = feed.select("user_id", "time", "action").unionByName(crowd)
    got = jobs.run_alerts(both, view(spark, SF_DIR, "message_actions"), NOW)
    assert {r.metric for r in got.collect()} >= {"users_feed", "views"}


def write_stream_input(spark, path):
    """The test events in three files, in time order."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    for lo, hi in ((1, 10), (11, 20), (21, 31)):
        part = events.where(F.dayofmonth("ts").between(lo, hi))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are taken by their time of change
    return events.schema


def feed_stream(spark, path, schema, lateness, **options):
    events = streams.read_event_stream(spark, path, schema, **options)
    return streams.feed_bucket_stream(spark.sql(VIEWS["feed_actions"], events=events), lateness)


def comparable(buckets):
    columns = [F.col("ts").cast("string"), "hm", "users_feed", "likes", "views", "ctr"]
    return rows(buckets.select(columns), "ts")


def test_nothing_is_written_while_late_events_may_come(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    stream = feed_stream(spark, source, write_stream_input(spark, source), "40 days")
    streams.append_closed_buckets(stream, sink, checkpoint).awaitTermination()
    assert spark.read.schema(stream.schema).parquet(sink).count() == 0


def test_stream_in_several_batches_equals_batch(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = write_stream_input(spark, source)
    stream = feed_stream(spark, source, schema, "0 minutes", files_per_batch=1)
    query = streams.append_closed_buckets(stream, sink, checkpoint)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress}) >= 3
    written = spark.read.schema(stream.schema).parquet(sink)

    feed = view(spark, SF_DIR, "feed_actions")
    batch = alerts.feed_buckets(feed, NOW)
    recent = written.where((F.col("ts") >= "2024-01-29") & (F.col("ts") < "2024-01-30 18:00"))
    assert comparable(recent) == comparable(batch)

    # a restart from the checkpoint finds nothing new and writes nothing twice
    before = written.count()
    streams.append_closed_buckets(stream, sink, checkpoint).awaitTermination()
    assert spark.read.schema(stream.schema).parquet(sink).count() == before

    checked = streams.check_written_buckets(written, alerts.FEED_METRICS, NOW)
    wanted = alerts.latest_checks(alerts.anomaly_bands(batch, alerts.FEED_METRICS))
    same = ["metric", "value", "previous", "low", "high", "is_alert", "text"]
    assert rows(checked.select(same), "metric") == rows(wanted.select(same), "metric")
