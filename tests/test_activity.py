"""Daily activity, slices, retention: the cases the test data does not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import activity, retention
from tidemark.plans import jobs
from tidemark.sources import sinks
from tidemark.sources.fixtures import AS_OF, view

FEED = "user_id long, time timestamp, action string, gender int, age int, os string, source string"
MESSAGES = (
    "user_id long, reciever_id long, time timestamp, gender int, age int, os string, source string"
)
DAY = dt.date(2024, 3, 2)
AT = dt.datetime(2024, 3, 1, 12)


def feed(spark, *events):
    return spark.createDataFrame([(u, t, a, 1, 20, os, "ads") for u, t, a, os in events], FEED)


def messages(spark, *events):
    return spark.createDataFrame([(u, r, t, 1, 20, os, "ads") for u, r, t, os in events], MESSAGES)


def test_only_yesterday_counts(spark):
    df = feed(
        spark,
        (1, dt.datetime(2024, 2, 29, 23, 59, 59), "like", "iOS"),
        (1, dt.datetime(2024, 3, 1), "like", "iOS"),
        (1, dt.datetime(2024, 3, 1, 23, 59, 59, 999999), "view", "iOS"),
        (1, dt.datetime(2024, 3, 2), "view", "iOS"),
    )
    assert rows(activity.feed_user_daily(df, DAY)) == [(1, dt.date(2024, 3, 1), 1, 20, "iOS", 1, 1)]


def test_user_who_only_receives(spark):
    sent = messages(spark, (1, 3, AT, "iOS"), (2, 3, AT, None), (2, 3, AT, None))
    nothing = activity.feed_user_daily(feed(spark), DAY)
    got = rows(activity.message_user_daily(sent, nothing, DAY), "user_id")
    day = dt.date(2024, 3, 1)
    assert got == [
        (1, day, 1, 20, "iOS", 1, None, 1, None),
        (2, day, 1, 20, None, 2, None, 1, None),
        (3, day, None, None, None, None, 3, None, 2),
    ]


def test_receiver_takes_attributes_from_the_feed(spark):
    sent = messages(spark, (1, 3, AT, "iOS"))
    seen = feed(spark, (3, AT, "view", "iOS"), (3, AT, "view", "Android"), (1, AT, "view", "iOS"))
    got = rows(activity.message_user_daily(sent, activity.feed_user_daily(seen, DAY), DAY), "user_id", "os")
    assert [(r[0], r[4], r[6]) for r in got] == [(1, "iOS", None), (3, "iOS", 1)]


def test_received_messages_count_once(spark):
    """Also for users with several sets of attributes, whether they sent or only received."""
    sent = messages(
        spark, *[(1, r, AT, os) for r in (2, 3) for os in ("iOS", "Android", None)], (2, 1, AT, "iOS"), (2, 1, AT, None)
    )
    seen = feed(spark, (3, AT, "view", "iOS"), (3, AT, "view", "Android"), (3, AT, "like", "Android"))
    total = jobs.slices(seen, sent, DAY).where("dimension = 'gender'").first()
    assert total.messages_received == total.messages_sent == 8
    got = rows(activity.message_user_daily(sent, activity.feed_user_daily(seen, DAY), DAY), "user_id", "os")
    assert [(r[0], r[4], r[6]) for r in got if r[6]] == [(1, "iOS", 2), (2, "iOS", 3), (3, "Android", 3)]
    published = jobs.slices(seen, sent, DAY, literal=True).where("dimension = 'gender'").first()
    assert published.messages_received == 3 * 2 + 2 * 3


def test_literal_mode(spark):
    sent = messages(spark, (1, 3, AT, "iOS"), (2, 1, AT, "iOS"), (3, 1, AT, "iOS"))
    daily = activity.feed_user_daily(feed(spark), DAY)
    got = rows(activity.message_user_daily(sent, daily, DAY, literal=True), "user_id")
    assert [(r[0], r[6], r[8]) for r in got] == [(1, 2, 1), (2, None, None), (3, 1, 1)]


def test_missing_os_merges_and_makes_no_slice(spark):
    seen = feed(spark, (1, AT, "like", None))
    sent = messages(spark, (1, 1, AT, None))
    feed_daily = activity.feed_user_daily(seen, DAY)
    both = activity.combine_actions(feed_daily, activity.message_user_daily(sent, feed_daily, DAY))
    assert both.count() == 1
    got = rows(activity.daily_slices(both), "dimension")
    assert [r[1:3] for r in got] == [("age", "20"), ("gender", "1")]
    assert got[0][3:] == (0.0, 1.0, 1.0, 1.0, 1.0, 1.0)


def test_missing_side_adds_zero(spark):
    got = rows(jobs.slices(feed(spark, (1, AT, "like", "iOS")), messages(spark), DAY), "dimension")
    assert {r[5:] for r in got} == {(0.0, 0.0, 0.0, 0.0)}


def test_combined_metrics_are_kept_whole(spark):
    """Each dimension without missing values adds up to the same totals."""
    sf = "/root/testdata/sf0.01"
    got = jobs.slices(view(spark, sf, "feed_actions"), view(spark, sf, "message_actions"), AS_OF)
    total = got.groupBy("dimension").agg(*[F.sum(m).alias(m) for m in activity.SLICE_METRICS])
    by = {r.dimension: tuple(r)[1:] for r in total.collect()}
    assert by["age"] == by["gender"]
    assert by["age"][:2] == tuple(
        activity.daily_summary(
            view(spark, sf, "feed_actions"), view(spark, sf, "message_actions"), AS_OF
        ).first()[i]
        for i in ("views", "likes")
    )


def test_ctr_without_views_is_null(spark):
    got = activity.daily_summary(feed(spark, (1, AT, "like", "iOS")), messages(spark), DAY).first()
    assert (got.likes, got.views, got.ctr, got.messages, got.dau) == (1, 0, None, 0, 1)


def test_approximate_users(spark):
    sf = "/root/testdata/sf0.01"
    tables = view(spark, sf, "feed_actions"), view(spark, sf, "message_actions")
    exact = rows(activity.active_users(*tables, AS_OF, 7, ["source"]), "date", "source")
    close = rows(activity.active_users(*tables, AS_OF, 7, ["source"], exact=False), "date", "source")
    for a, b in zip(exact, close):
        assert a[:2] == b[:2] and b[2] == pytest.approx(a[2], rel=0.15)


def test_retention_counts_first_days_in_the_window(spark):
    at = lambda d, h=1: dt.datetime(2024, 3, d, h)
    seen = feed(
        spark,
        (1, at(1), "view", "iOS"),  # started before the window
        (1, at(5), "view", "iOS"),
        (2, at(4), "view", "iOS"),
        (2, at(4, 5), "view", "iOS"),
        (2, at(6), "view", "iOS"),
        (3, at(10), "view", "iOS"),  # the running day counts
        (4, at(11), "view", "iOS"),  # after it
    )
    sent = messages(spark, (5, 1, at(4), "iOS"), (2, 1, at(10), "iOS"))
    got = rows(retention.app_retention(seen, sent, dt.date(2024, 3, 10)), "start_day", "day")
    d = lambda n: dt.date(2024, 3, n)
    assert got == [(d(4), d(4), 2), (d(4), d(6), 1), (d(4), d(10), 1), (d(10), d(10), 1)]
    wide = retention.retention_matrix(
        retention.app_retention(seen, sent, dt.date(2024, 3, 10)), dt.date(2024, 3, 10)
    )
    assert wide.columns == ["start_day"] + [f"2024-03-{n:02d}" for n in range(3, 11)]
    assert wide.where("start_day = '2024-03-04'").first()["2024-03-04"] == 2.0


def test_daily_sink_replaces_a_day(spark, tmp_path):
    path = str(tmp_path / "slices")
    first = feed(spark, (1, AT, "like", "iOS"))
    later = feed(spark, (1, AT + dt.timedelta(days=1), "like", "iOS"))
    none = messages(spark)
    jobs.run_daily_slices(first, none, DAY, path)
    jobs.run_daily_slices(later, none, DAY + dt.timedelta(days=1), path)
    jobs.run_daily_slices(first, none, DAY, path)
    table = spark.read.schema(sinks.SLICE_SCHEMA).parquet(path)
    assert {tuple(r) for r in table.groupBy("event_date").count().collect()} == {
        (dt.date(2024, 3, 1), 3),
        (dt.date(2024, 3, 2), 3),
    }


def test_summary_report(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    report = jobs.summary_report(view(spark, sf, "feed_actions"), view(spark, sf, "message_actions"), AS_OF)
    assert {k: v.columns[0] for k, v in report.items()} == {
        "summary": "date",
        "feed": "date",
        "messages": "date",
        "dau": "date",
        "retention": "start_day",
    }
    jobs.export_retention(report, str(tmp_path / "retention"))
    text = spark.read.csv(str(tmp_path / "retention"), header=True)
    assert text.columns[0] == "start_day" and text.count() == report["retention"].count()
