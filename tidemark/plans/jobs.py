"""The recurring jobs, each one plan from the tables to its result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.operators import abtest, activity, alerts, retention
from tidemark.session import stage
from tidemark.sources.sinks import write_csv, write_daily


def slices(feed: DataFrame, messages: DataFrame, as_of: dt.date, literal: bool = False) -> DataFrame:
    """Yesterday's user metrics by gender, os and age; ``literal`` as in ``message_user_daily``.

    The feed's rows per user serve twice, as metrics and as attributes of users who only received
    messages. They are staged, so the events of the day are read once.
    """
    feed_daily = stage(activity.feed_user_daily(feed, as_of), "feed-daily")
    message_daily = activity.message_user_daily(messages, feed_daily, as_of, literal)
    return activity.daily_slices(activity.combine_actions(feed_daily, message_daily))


def run_daily_slices(
    feed: DataFrame, messages: DataFrame, as_of: dt.date, path: str, literal: bool = False
) -> None:
    """Daily job: add yesterday to the slice table. Running it again replaces the day."""
    write_daily(slices(feed, messages, as_of, literal), path)


def summary_report(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """Daily report: yesterday in one row, the last seven days and the retention matrix."""
    retained = retention.app_retention(feed, messages, as_of)
    return {
        "summary": activity.daily_summary(feed, messages, as_of),
        "feed": activity.feed_series(feed, as_of),
        "messages": activity.message_series(messages, as_of),
        "dau": activity.active_users(feed, messages, as_of, 7, ["source"]),
        "retention": retention.retention_matrix(retained, as_of),
    }


def export_retention(report: dict[str, DataFrame], path: str) -> None:
    write_csv(report["retention"].coalesce(1), path)  # at most one row per day of the window


def run_alerts(feed: DataFrame, messages: DataFrame, now: dt.datetime) -> DataFrame:
    """Quarter-hourly job: the metrics whose newest value lies outside its band."""
    checks = [
        alerts.anomaly_bands(alerts.feed_buckets(feed, now), alerts.FEED_METRICS),
        alerts.anomaly_bands(alerts.message_buckets(messages, now), alerts.MESSAGE_METRICS),
    ]
    return alerts.alerts(checks[0]).unionByName(alerts.alerts(checks[1]))


def experiment_report(
    groups: DataFrame, groups_add: DataFrame, active: DataFrame, checks: DataFrame
) -> dict[str, DataFrame]:
    """Group metrics and tests: conversion, revenue per user and revenue per payer."""
    members = abtest.participants(groups, groups_add, active, checks)
    users = stage(abtest.active_or_paying(members), "participants")  # six results read them
    paying = users.where(abtest.paid())
    return {
        "metrics": abtest.group_metrics(users),
        "conversion": abtest.chi_square(abtest.pay_counts(users), "grp", "pay"),
        "per_user": abtest.mann_whitney(users, "rev", "grp", weight="times"),
        "per_payer": abtest.mann_whitney(paying, "rev", "grp", weight="times"),
        "per_user_bootstrap": abtest.bootstrap_summary(
            abtest.bootstrap_differences(users, "rev", "grp", weight="times")
        ),
        "per_payer_bootstrap": abtest.bootstrap_summary(
            abtest.bootstrap_differences(paying, "rev", "grp", weight="times")
        ),
    }
