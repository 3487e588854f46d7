"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import days_before, time_range
from tidemark.operators import (
    abtest,
    activity,
    alerts,
    campaigns,
    commerce,
    courses,
    distributions,
    retention,
)
from tidemark.operators import cohorts as cohort_tables
from tidemark.operators import rfm as segments
from tidemark.plans import jobs
from tidemark.session import CLUSTER_CONF, scratch_path, stage
from tidemark.sources import files, fixtures, profile, sinks, tables
from tidemark.sources.fixtures import AS_OF, CUSTOMER, NOW
from tidemark.streaming import alerts as streams


# between the two lots of orders of `cohorts_incremental`
SECOND_LOT = dt.datetime(1995, 6, 17)


class Tables:
    """The views of one test directory, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in fixtures.VIEWS:
            raise AttributeError(name)
        return fixtures.view(self.spark, self.sf_dir, name)


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame, places: int = 6) -> DataFrame:
    """Dates and times as text, whole numbers as bigint, floats rounded: the same in any engine."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), places)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return plain(QUERIES[name](Tables(spark, sf_dir)))


# sources and sinks


@query
def read_semicolon(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "checks-csv")
    t.checks.write.csv(path, header=True, sep=";", quoteAll=True)
    return files.read_csv(t.spark, path, files.CHECKS_SCHEMA, sep=";")


@query
def read_decimal_comma(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "campaigns-csv")
    table = t.campaigns.select("campaign_id", "geo", "buyer", "installs", "registrations", "spend")
    comma = F.replace(F.format_string("%.6f", "spend"), F.lit("."), F.lit(","))
    table.withColumn("spend", comma).write.csv(path, header=True)
    schema = "campaign_id bigint, geo string, buyer string, installs bigint, registrations bigint, spend double"
    read = files.read_decimal_comma(t.spark, path, schema)
    return read.withColumn("spend", F.round("spend", 4))


@query
def daily_slice_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "slices")
    for _ in range(2):  # a repeated run must not double the day
        jobs.run_daily_slices(t.feed_actions, t.message_actions, AS_OF, path)
    return t.spark.read.schema(sinks.SLICE_SCHEMA).parquet(path)


@query
def profile_nulls(t: Tables) -> DataFrame:
    return profile.null_profile(t.orders_ds).drop("data_type")


# daily activity


@query
def feed_user_daily(t: Tables) -> DataFrame:
    return activity.feed_user_daily(t.feed_actions, AS_OF)


def _message_daily(t: Tables, literal: bool = False) -> DataFrame:
    feed_daily = activity.feed_user_daily(t.feed_actions, AS_OF)
    return activity.message_user_daily(t.message_actions, feed_daily, AS_OF, literal)


@query
def message_user_daily(t: Tables) -> DataFrame:
    return _message_daily(t)


@query
def message_user_daily_literal(t: Tables) -> DataFrame:
    return _message_daily(t, literal=True)


@query
def action_comb(t: Tables) -> DataFrame:
    feed_daily = activity.feed_user_daily(t.feed_actions, AS_OF)
    return activity.combine_actions(feed_daily, _message_daily(t))


@query
def daily_slices(t: Tables) -> DataFrame:
    return jobs.slices(t.feed_actions, t.message_actions, AS_OF)


@query
def daily_slices_literal(t: Tables) -> DataFrame:
    return jobs.slices(t.feed_actions, t.message_actions, AS_OF, literal=True)


@query
def daily_summary(t: Tables) -> DataFrame:
    return activity.daily_summary(t.feed_actions, t.message_actions, AS_OF)


@query
def feed_week(t: Tables) -> DataFrame:
    return activity.feed_series(t.feed_actions, AS_OF)


@query
def messages_daily(t: Tables) -> DataFrame:
    return activity.message_series(t.message_actions, AS_OF, days=1)


@query
def messages_week(t: Tables) -> DataFrame:
    return activity.message_series(t.message_actions, AS_OF)


@query
def dau_yesterday(t: Tables) -> DataFrame:
    return activity.active_users(t.feed_actions, t.message_actions, AS_OF)


@query
def dau_by_source(t: Tables) -> DataFrame:
    return activity.active_users(t.feed_actions, t.message_actions, AS_OF, 7, ["source"])


@query
def app_retention(t: Tables) -> DataFrame:
    return retention.app_retention(t.started_feed, t.started_messages, AS_OF)


@query
def app_retention_90(t: Tables) -> DataFrame:
    return retention.app_retention(t.started_feed, t.started_messages, AS_OF, days=90)


@query
def app_retention_pivot(t: Tables) -> DataFrame:
    return retention.retention_matrix(app_retention(t), AS_OF)


@query
def retention_incremental(t: Tables) -> DataFrame:
    """The state is built once, then moved on day by day; each run reads one day of events."""
    path = scratch_path(t.spark, "retention-state")
    for back in (3, 2, 1, 0):
        day = days_before(AS_OF, back)
        state = retention.advance_state(t.spark, path, t.started_feed, t.started_messages, day)
    return retention.retention_of_state(state, AS_OF)


SKETCHED_DAYS = (1, 7, 30)


@query
def dau_sketch_rollup(t: Tables) -> DataFrame:
    """Users of several stretches of days: counted exactly, and whether the stored sketches agree."""
    sketches = activity.daily_sketches(t.feed_actions, t.message_actions, AS_OF, max(SKETCHED_DAYS), ["source"])
    sketches = stage(sketches, "daily-sketches")
    columns = ["user_id", "time", "source"]
    both = t.feed_actions.select(*columns).unionByName(t.message_actions.select(*columns))
    found = []
    for days in SKETCHED_DAYS:
        rows = time_range(both, "time", days_before(AS_OF, days), AS_OF)
        exact = rows.groupBy("source").agg(F.count_distinct("user_id").alias("users"))
        estimated = activity.users_of_sketches(sketches, AS_OF, days, ["source"])
        off = F.abs(F.col("estimated_users") - F.col("users")) <= F.col("users") * activity.SKETCH_ERROR
        found.append(exact.join(estimated, "source").select(F.lit(days).alias("days"), "source", "users", off.alias("agrees")))
    return functools.reduce(DataFrame.unionByName, found)


# alerts


@query
def alert_feed_buckets(t: Tables) -> DataFrame:
    return alerts.feed_buckets(t.feed_actions, NOW)


@query
def alert_message_buckets(t: Tables) -> DataFrame:
    return alerts.message_buckets(t.message_actions, NOW)


@query
def alert_feed_buckets_filled(t: Tables) -> DataFrame:
    return alerts.fill_gaps(alerts.feed_buckets(t.feed_actions, NOW))


def _feed_bands(t: Tables, edge: str = "shrink") -> DataFrame:
    return alerts.anomaly_bands(alerts.feed_buckets(t.feed_actions, NOW), alerts.FEED_METRICS, edge=edge)


@query
def anomaly_bands(t: Tables) -> DataFrame:
    return _feed_bands(t)


@query
def anomaly_bands_strict(t: Tables) -> DataFrame:
    return _feed_bands(t, "strict")


@query
def anomaly_latest(t: Tables) -> DataFrame:
    return alerts.latest_checks(_feed_bands(t))


@query
def anomaly_latest_messages(t: Tables) -> DataFrame:
    buckets = alerts.message_buckets(t.message_actions, NOW)
    return alerts.latest_checks(alerts.anomaly_bands(buckets, alerts.MESSAGE_METRICS))


@query
def alert_rows(t: Tables) -> DataFrame:
    return jobs.run_alerts(t.feed_burst, t.message_actions, NOW)


# advertising


@query
def campaign_metrics(t: Tables) -> DataFrame:
    return campaigns.campaign_metrics(t.campaigns).withColumn("Revenue_30d", F.round("Revenue_30d", 4))


def _rounded_totals(df: DataFrame) -> DataFrame:
    money = ["Spend", "Revenue_ad30d", "Revenue_in_app30d", "Revenue_30d"]
    return df.withColumns({name: F.round(name, 4) for name in money})


@query
def geo_metrics(t: Tables) -> DataFrame:
    return _rounded_totals(campaigns.group_metrics(t.campaigns, "Geo"))


@query
def buyer_metrics(t: Tables) -> DataFrame:
    return _rounded_totals(campaigns.buyer_ranking(t.campaigns))


@query
def top_campaigns_ctr(t: Tables) -> DataFrame:
    return campaigns.top_campaigns(campaigns.campaign_metrics(t.campaigns), "CTR")


@query
def top_campaigns_cpi(t: Tables) -> DataFrame:
    return campaigns.top_campaigns(campaigns.campaign_metrics(t.campaigns), "CPI", ascending=True)


@query
def top_campaigns_roi(t: Tables) -> DataFrame:
    return campaigns.top_campaigns(campaigns.campaign_metrics(t.campaigns), "ROI_30d")


# shop


@query
def single_purchase_customers(t: Tables) -> DataFrame:
    return commerce.single_purchase_customers(t.customers, t.orders_ds)


@query
def customers_total(t: Tables) -> DataFrame:
    return commerce.customers_total(t.customers)


@query
def undelivered_monthly(t: Tables) -> DataFrame:
    return commerce.undelivered_monthly(t.orders_ds)


@query
def undelivered_by_reason(t: Tables) -> DataFrame:
    return commerce.undelivered_by_reason(commerce.undelivered_monthly(t.orders_ds))


@query
def product_weekday_mode(t: Tables) -> DataFrame:
    modes = commerce.product_weekday_mode(t.order_items, t.orders_ds)
    return modes.withColumn("day_of_week", F.array_join("day_of_week", ","))


@query
def orders_per_week(t: Tables) -> DataFrame:
    return commerce.orders_per_week(t.customers, t.orders_ds)


@query
def customer_history(t: Tables) -> DataFrame:
    return commerce.customer_history(commerce.orders_per_week(t.customers, t.orders_ds), CUSTOMER)


@query
def customer_history_lookup(t: Tables) -> DataFrame:
    """The same from a copy in order of customers, of which only the customer's row groups are read."""
    path = scratch_path(t.spark, "purchases")
    tables.write_clustered(commerce.purchases(t.customers, t.orders_ds), path, "customer_unique_id")
    return commerce.customer_history(commerce.purchases_per_week(t.spark.read.parquet(path)), CUSTOMER)


@query
def order_span(t: Tables) -> DataFrame:
    return commerce.order_span(t.customers, t.orders_ds)


@query
def cohorts(t: Tables) -> DataFrame:
    return cohort_tables.cohorts(t.customers, t.orders_ds)


@query
def cohort_pivot(t: Tables) -> DataFrame:
    return cohort_tables.cohort_matrix(cohorts(t))


@query
def cohorts_incremental(t: Tables) -> DataFrame:
    """Orders come in two lots; months of the first are kept and merged with those of the second."""
    early = t.orders_ds.where(F.col("order_purchase_timestamp") < SECOND_LOT)
    late = t.orders_ds.where(F.col("order_purchase_timestamp") >= SECOND_LOT)
    kept = stage(cohort_tables.customer_months(t.customers, early), "customer-months")
    return cohort_tables.cohorts_of_months(cohort_tables.customer_months(t.customers, late, kept))


@query
def cohort_retention(t: Tables) -> DataFrame:
    return cohort_tables.cohort_retention(cohorts(t))


@query
def best_cohort_m3(t: Tables) -> DataFrame:
    return cohort_tables.best_cohorts(cohort_retention(t))


def _rfm_base(t: Tables) -> DataFrame:
    return segments.staged_base(t.customers, t.orders_ds, t.order_items)


@query
def rfm_base(t: Tables) -> DataFrame:
    return _rfm_base(t)


@query
def rfm_quintiles(t: Tables) -> DataFrame:
    return segments.rfm_quintiles(_rfm_base(t))


@query
def rfm_quintiles_ranged(t: Tables) -> DataFrame:
    return segments.rfm_quintiles(_rfm_base(t), values_per_range=100)


@query
def frequency_counts(t: Tables) -> DataFrame:
    return segments.frequency_counts(_rfm_base(t))


@query
def rfm(t: Tables) -> DataFrame:
    return segments.rfm(_rfm_base(t))


@query
def rfm_segment_share(t: Tables) -> DataFrame:
    return segments.segment_share(segments.rfm(_rfm_base(t)))


@query
def rfm_segment_bounds(t: Tables) -> DataFrame:
    return segments.segment_bounds(segments.rfm(_rfm_base(t)))


# experiment


def _members(t: Tables) -> DataFrame:
    return abtest.participants(t.groups, t.groups_add, t.active_studs, t.checks)


def _users(t: Tables) -> DataFrame:
    return abtest.active_or_paying(_members(t))


def _paying(t: Tables) -> DataFrame:
    return _users(t).where(abtest.paid())


@query
def duplicate_checks(t: Tables) -> DataFrame:
    return distributions.duplicate_rows(t.repeated_checks)


@query
def duplicate_purchases(t: Tables) -> DataFrame:
    return distributions.duplicate_rows(t.final_project_check.select("st_id", "subject"))


@query
def ab_active_users(t: Tables) -> DataFrame:
    return _users(t)


@query
def ab_payers(t: Tables) -> DataFrame:
    return abtest.payers(_members(t))


@query
def ab_inactive_payers(t: Tables) -> DataFrame:
    return abtest.inactive_payers(_members(t))


@query
def rev_frequency(t: Tables) -> DataFrame:
    members = _members(t)
    return distributions.frequency(
        members.where((F.col("active") == "no") & abtest.paid()), "rev", weight="times"
    )


@query
def rev_frequency_active(t: Tables) -> DataFrame:
    return distributions.frequency(_members(t).where("active = 'yes'"), "rev", weight="times")


@query
def rev_frequency_by_group(t: Tables) -> DataFrame:
    return distributions.frequency(_users(t), "rev", ["grp"], "times")


@query
def rev_describe(t: Tables) -> DataFrame:
    return distributions.describe(_users(t), "rev", "grp", "times")


@query
def rev_box(t: Tables) -> DataFrame:
    return distributions.box_summary(_users(t), "rev", "grp", "times")


@query
def rev_box_payers(t: Tables) -> DataFrame:
    return distributions.box_summary(_paying(t), "rev", "grp", "times")


@query
def rev_histogram(t: Tables) -> DataFrame:
    return distributions.histogram(_users(t), "rev", 50, ["grp"], "times")


@query
def rev_histogram_payers(t: Tables) -> DataFrame:
    return distributions.histogram(_paying(t), "rev", 50, ["grp"], "times")


@query
def rev_describe_sketch(t: Tables) -> DataFrame:
    """Quartiles of merged daily sketches: exact counts, and whether each quartile's rank is near enough."""
    sales = t.final_project_check
    kept = stage(distributions.daily_value_sketches(sales, "money", "sale_time", ["subject"]), "value-sketches")
    found = []
    for days in (7, 30):
        since = days_before(AS_OF, days)
        described = distributions.describe_sketches(kept.where(F.col("date").between(since, AS_OF)), ["subject"])
        inside = time_range(sales, "sale_time", since, days_before(AS_OF, -1)).where(F.col("money").isNotNull())
        ranks = inside.join(described, "subject").groupBy("subject", "count", "mean", "min", "max")
        near = [
            (
                (F.avg((F.col("money") < F.col(q)).cast("int")) <= share + distributions.RANK_ERROR)
                & (F.avg((F.col("money") <= F.col(q)).cast("int")) >= share - distributions.RANK_ERROR)
            ).alias(f"{q}_agrees")
            for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        ]
        found.append(ranks.agg(*near).withColumn("days", F.lit(days)))
    return functools.reduce(DataFrame.unionByName, found)


@query
def ab_group_metrics(t: Tables) -> DataFrame:
    return abtest.recalculated_metrics(t.groups, t.groups_add, t.active_studs, t.checks)


@query
def ab_metric_bars(t: Tables) -> DataFrame:
    return abtest.metric_bars(ab_group_metrics(t))


@query
def ab_crosstab(t: Tables) -> DataFrame:
    return abtest.pay_crosstab(_users(t))


@query
def chi_square(t: Tables) -> DataFrame:
    return abtest.chi_square(abtest.pay_counts(_users(t)), "grp", "pay")


@query
def mann_whitney(t: Tables) -> DataFrame:
    return abtest.mann_whitney(_users(t), "rev", "grp", weight="times")


@query
def mann_whitney_payers(t: Tables) -> DataFrame:
    return abtest.mann_whitney(_paying(t), "rev", "grp", weight="times")


@query
def mann_whitney_exact(t: Tables) -> DataFrame:
    """Two regions by their nations' revenue: few values, none of which are alike."""
    return abtest.mann_whitney_exact(t.nation_revenue, "revenue", "region", ("ASIA", "EUROPE"))


@query
def mann_whitney_ranged(t: Tables) -> DataFrame:
    arms = ("view", "click")
    return abtest.mann_whitney(t.event_values, "value", "event_type", arms, values_per_range=100)


def _differences(users: DataFrame, **options) -> DataFrame:
    return abtest.bootstrap_differences(users, "rev", "grp", weight="times", **options)


@query
def bootstrap_ab(t: Tables) -> DataFrame:
    return abtest.bootstrap_summary(_differences(_users(t)))


@query
def bootstrap_ab_payers(t: Tables) -> DataFrame:
    return abtest.bootstrap_summary(_differences(_paying(t)))


@query
def bootstrap_median(t: Tables) -> DataFrame:
    return abtest.bootstrap_summary(_differences(_paying(t), statistic="median", values_per_range=2))


@query
def bootstrap_histogram(t: Tables) -> DataFrame:
    return abtest.bootstrap_histogram(_differences(_users(t)))


# courses


@query
def diligent_students(t: Tables) -> DataFrame:
    return courses.diligent_students(t.peas, AS_OF)


@query
def diligent_students_text(t: Tables) -> DataFrame:
    """The month as text, and times that come as text."""
    path = scratch_path(t.spark, "peas-csv")
    files_of = t.peas.withColumn("timest", F.date_format("timest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    files_of.write.csv(path, header=True)
    text = files.read_csv(t.spark, path, "st_id bigint, timest string, correct boolean, subject string")
    return courses.diligent_students(files.parse_times(text, ["timest"]), AS_OF.isoformat())


@query
def catalog_matrix(t: Tables) -> DataFrame:
    """A table of the catalog, read for a week; tasks by subject and day as a matrix, written as CSV and read back."""
    name = f"peas_{uuid.uuid4().hex}"
    with_day = t.peas.withColumn("day", F.to_date("timest"))
    sinks.write_daily_table(with_day, name, "day")
    week = (days_before(AS_OF, 7), AS_OF)
    try:
        rows = tables.read_table(t.spark, name, ["subject", "day"], "timest", *week, day="day")
        shown = [days_before(AS_OF, back).isoformat() for back in range(7, 0, -1)]
        dated = rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        tasks = dated.groupBy("subject").pivot("day", shown).count()
        path = scratch_path(t.spark, "matrix-csv")
        sinks.write_csv(tasks.coalesce(1), path)
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = "subject string, " + ", ".join(f"`{day}` bigint" for day in shown)
    return files.read_csv(t.spark, path, schema)


@query
def funnel_metrics(t: Tables) -> DataFrame:
    return courses.funnel_metrics(t.studs, t.peas, t.final_project_check)


# streams


def _event_stream(t: Tables, view: str) -> DataFrame:
    schema = fixtures.read(t.spark, t.sf_dir, "events").schema
    events = streams.read_event_stream(t.spark, t.sf_dir, schema, "events.parquet")
    return t.spark.sql(fixtures.VIEWS[view], events=events)


# the test table is one file, read in one batch, so no event can come late
IN_ORDER = "0 minutes"


def _written_feed_buckets(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "buckets")
    stream = streams.feed_bucket_stream(_event_stream(t, "feed_actions"), IN_ORDER)
    checkpoint = scratch_path(t.spark, "buckets-checkpoint")
    streams.append_closed_buckets(stream, path, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path)


@query
def stream_alert_buckets(t: Tables) -> DataFrame:
    return _written_feed_buckets(t)


@query
def stream_message_buckets(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "message-buckets")
    stream = streams.message_bucket_stream(_event_stream(t, "message_actions"), IN_ORDER)
    checkpoint = scratch_path(t.spark, "message-buckets-checkpoint")
    streams.append_closed_buckets(stream, path, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path)


@query
def stream_late_buckets(t: Tables) -> DataFrame:
    """Events arrive in four files that each span all days, so most are late behind those before them."""
    events = scratch_path(t.spark, "late-events")
    fixtures.read(t.spark, t.sf_dir, "events").repartition(4, "event_id").write.parquet(events)
    schema = t.spark.read.parquet(events).schema
    view = lambda table: t.spark.sql(fixtures.VIEWS["feed_actions"], events=table)
    stream = view(streams.read_event_stream(t.spark, events, schema, files_per_batch=1))
    path, checkpoint = scratch_path(t.spark, "late-buckets"), scratch_path(t.spark, "late-checkpoint")
    table = lambda: view(t.spark.read.schema(schema).parquet(events))
    streams.recount_touched_buckets(stream, table, alerts.count_feed, path, checkpoint).awaitTermination()
    return streams.current_buckets(t.spark, path)


@query
def stream_alerts_stateful(t: Tables) -> DataFrame:
    buckets = _written_feed_buckets(t)
    path, checkpoint = scratch_path(t.spark, "checks"), scratch_path(t.spark, "checks-checkpoint")
    arriving = streams.read_event_stream(t.spark, buckets.inputFiles()[0].split("/date=")[0], buckets.schema)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, CLUSTER_CONF[key])
    try:
        checks = streams.check_bucket_stream(arriving, alerts.FEED_METRICS)
        streams.append_rows(checks, path, checkpoint).awaitTermination()
    finally:
        t.spark.conf.set(key, before)
    return t.spark.read.schema(checks.schema).parquet(path)


@query
def stream_alerts(t: Tables) -> DataFrame:
    return streams.check_written_buckets(_written_feed_buckets(t), alerts.FEED_METRICS, NOW)
