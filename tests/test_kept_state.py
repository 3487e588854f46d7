"""Results kept between runs: late events, retention state, sketches, months of customers."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import activity, alerts, cohorts, distributions, retention
from tidemark.session import CLUSTER_CONF
from tidemark.sources import tables
from tidemark.streaming import alerts as streams

DAY = dt.date(2024, 3, 10)


def events(spark, n=4000, days=20, users=90, seed=1):
    rng = np.random.default_rng(seed)
    seconds = rng.integers(0, days * 86400, n)
    start = pd.Timestamp(DAY) - pd.Timedelta(days=days - 1)
    frame = pd.DataFrame(
        {
            "user_id": rng.integers(0, users, n) * rng.integers(1, 3, n),
            "time": start + pd.to_timedelta(seconds, unit="s"),
            "action": rng.choice(["like", "view"], n),
            "source": rng.choice(["ads", "organic"], n),
        }
    )
    return spark.createDataFrame(frame)


# late events


def written(spark, path, parts):
    """One file after the other, so a stream that reads one a batch sees them in this order."""
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(path)
        newest = max((e.path for e in os.scandir(path) if e.name.startswith("part")), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + 10 * k,) * 2)


def maintained(spark, tmp_path, parts, counted=alerts.count_feed):
    path, schema = str(tmp_path / "events"), parts[0].schema
    written(spark, path, parts)
    table = lambda: spark.read.schema(schema).parquet(path)
    stream = streams.read_event_stream(spark, path, schema, files_per_batch=1)
    places = str(tmp_path / "buckets"), str(tmp_path / "checkpoint")
    streams.recount_touched_buckets(stream, table, counted, *places).awaitTermination()
    return table, places


def test_late_events_are_counted(spark, tmp_path):
    whole = events(spark, 600, 3)
    newest_first = [whole.where(F.hour("time") >= 12), whole.where(F.hour("time") < 12)]
    table, (path, _) = maintained(spark, tmp_path, newest_first)
    got = streams.current_buckets(spark, path)
    want = alerts.count_feed(whole.withColumn("ts", F.window("time", "15 minutes")["start"]))
    assert rows(got.select(*want.columns), "ts") == rows(want, "ts")
    since = streams.current_buckets(spark, path, DAY)
    assert {r["date"] for r in since.collect()} == {DAY}


def test_only_touched_buckets_get_a_version(spark, tmp_path):
    whole = events(spark, 600, 3)
    late = whole.where((F.col("time") >= F.lit(dt.datetime(2024, 3, 9, 6))) & (F.col("time") < F.lit(dt.datetime(2024, 3, 9, 7))))
    first = whole.join(late.select("time"), "time", "left_anti")
    _, (path, _) = maintained(spark, tmp_path, [first, late])
    second = spark.read.parquet(f"{path}/version=1").collect()
    assert second and all(r["hm"].startswith("06:") for r in second)
    assert not rows(spark.read.parquet(f"{path}/version=0").where("hm LIKE '06:%' AND date = DATE '2024-03-09'"), "ts")


def test_messages_null_times_and_restart(spark, tmp_path):
    schema = "user_id long, time timestamp"
    at = lambda h, m: dt.datetime(2024, 3, 9, h, m)
    first = spark.createDataFrame([(1, at(10, 1)), (None, at(10, 2)), (3, None)], schema)
    again = spark.createDataFrame([(1, at(10, 5)), (2, at(9, 59))], schema)
    table, (path, checkpoint) = maintained(spark, tmp_path, [first, again], alerts.count_messages)
    want = [(at(9, 45), 1, 1), (at(10, 0), 1, 2)]
    got = lambda: rows(streams.current_buckets(spark, path).select("ts", "users_message", "messages"), "ts")
    assert got() == want
    stream = streams.read_event_stream(spark, str(tmp_path / "events"), schema, files_per_batch=1)
    streams.recount_touched_buckets(stream, table, alerts.count_messages, path, checkpoint).awaitTermination()
    assert got() == want


def test_events_of_many_days_are_one_stretch(spark):
    touched = spark.sql("SELECT explode(sequence(TIMESTAMP '2023-01-01', TIMESTAMP '2023-06-01', INTERVAL 1 DAY)) AS ts")
    inside = streams._in_touched_days(events(spark, 10), touched)
    assert inside.count() == 0
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("2023-") == 2


# the stateful band check


def buckets(spark, n, seed):
    rng = np.random.default_rng(seed)
    ts = pd.date_range("2024-03-09", periods=n, freq="15min")
    frame = pd.DataFrame({"ts": ts, "views": rng.poisson(50, n).astype(float), "ctr": rng.random(n).round(3)})
    frame.loc[n // 2, "views"] = 900.0
    frame.loc[::11, "ctr"] = np.nan
    return frame


def test_checks_leave_with_their_bucket(spark, tmp_path):
    """Buckets in several batches; each row as the newest of a table that ends with it."""
    frame = buckets(spark, 40, 5)
    path = str(tmp_path / "closed")
    schema = "ts timestamp, views double, ctr double"
    parts = [frame[:17], frame[17:18], frame[18:]]
    plain = lambda row: (row.ts.to_pydatetime(), row.views, None if np.isnan(row.ctr) else row.ctr)
    typed = [spark.createDataFrame([plain(r) for r in p.itertuples()], schema) for p in parts]
    written(spark, path, [t.orderBy(F.desc("ts")) for t in typed])
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, CLUSTER_CONF[key])
    try:
        stream = streams.read_event_stream(spark, path, schema, files_per_batch=1)
        out = str(tmp_path / "checks")
        checks = streams.check_bucket_stream(stream, ["views", "ctr"])
        streams.append_rows(checks, out, str(tmp_path / "checkpoint")).awaitTermination()
    finally:
        spark.conf.set(key, before)
    got = {(r["metric"], r["ts"]): r for r in spark.read.parquet(out).collect()}
    assert len(got) == 80 and got["views", frame["ts"][20].to_pydatetime()]["is_alert"]
    whole = typed[0].unionByName(typed[1]).unionByName(typed[2])
    for upto in (3, 5, 6, 8, 18, 20, 23, 39):
        ended = whole.where(F.col("ts") <= F.lit(frame["ts"][upto].to_pydatetime()))
        for want in alerts.latest_checks(alerts.anomaly_bands(ended, ["views", "ctr"])).collect():
            mine = got[want["metric"], want["ts"]]
            for c in ("value", "previous", "low", "high", "change"):
                a, b = (np.nan if r[c] is None else r[c] for r in (mine, want))
                assert a == pytest.approx(b, nan_ok=True), (upto, want["metric"], c)
            assert mine["is_alert"] == want["is_alert"]


# lookups and sketches of values


def test_a_lookup_reads_a_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "copy")
    df = spark.range(200_000).selectExpr("xxhash64(id) % 20000 AS k", "id AS v")
    tables.write_clustered(df, path, "k", row_group_bytes=1 << 16)
    one = df.first()["k"]
    found = spark.read.parquet(path).where(F.col("k") == one)
    assert found.count() == df.where(F.col("k") == one).count()
    metrics = {}
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        metrics[i] = leaves.apply(i).metrics().apply("numOutputRows").value()
    assert 0 < sum(metrics.values()) <= 20_000


def test_value_sketches_of_days(spark):
    feed = events(spark, 30_000, 10).withColumn("value", F.abs(F.hash("time", "user_id") % 100_000) / 100)
    feed = feed.unionByName(feed.limit(5).withColumn("value", F.lit(float("nan"))))
    kept = distributions.daily_value_sketches(feed, "value", "time", ["source"])
    assert kept.count() == 20
    for got in distributions.describe_sketches(kept, ["source"]).collect():
        values = np.array([r["value"] for r in feed.where(F.col("source") == got["source"]).collect()])
        values = np.sort(values[~np.isnan(values)])
        assert (got["count"], got["min"], got["max"]) == (len(values), values[0], values[-1])
        assert got["mean"] == pytest.approx(values.mean())
        for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            assert abs(np.searchsorted(values, got[q]) / len(values) - share) <= distributions.RANK_ERROR
        assert got["whisker_low"] >= got["min"] and got["whisker_high"] <= got["max"]


# retention


def test_state_follows_the_history(spark, tmp_path):
    feed, messages = events(spark), events(spark, 500, seed=2)
    path = str(tmp_path)
    for back in range(5, -1, -1):
        day = DAY - dt.timedelta(days=back)
        state = retention.advance_state(spark, path, feed, messages, day)
        for days in (1, 7, 19):
            got = retention.retention_of_state(state, day, days)
            want = retention.app_retention(feed, messages, day, days)
            assert rows(got.select(*want.columns), "start_day", "day") == rows(want, "start_day", "day")
    first = rows(state, "user_id")
    assert rows(retention.advance_state(spark, path, feed, messages, DAY), "user_id") == first


def test_a_run_reads_one_day(spark):
    state = retention.retention_state(events(spark), events(spark, 10), DAY)
    none = events(spark, 1).limit(0)
    moved = retention.next_state(state, none, none, DAY + dt.timedelta(days=1))
    before = {r["user_id"]: r["active"] for r in state.collect()}
    assert {r["user_id"]: r["active"] for r in moved.collect()} == {u: (a << 1) & (2**62 - 1) for u, a in before.items()}


def test_late_events_enter_by_reading_more_days(spark):
    old = spark.createDataFrame([(1, dt.datetime(2024, 3, 8, 9))], "user_id long, time timestamp")
    late = spark.createDataFrame([(2, dt.datetime(2024, 3, 8, 23)), (1, None), (None, dt.datetime(2024, 3, 10))], old.schema)
    state = retention.retention_state(old, old, dt.date(2024, 3, 9))
    missed = retention.next_state(state, late, old, DAY)
    assert [r["user_id"] for r in missed.collect()] == [1]
    found = retention.next_state(state, late, old, DAY, reread_days=3)
    assert rows(found, "user_id") == [(1, dt.date(2024, 3, 8), 4), (2, dt.date(2024, 3, 8), 4)]


def test_windows_that_a_mask_cannot_hold(spark):
    with pytest.raises(ValueError):
        retention.retention_of_state(retention.retention_state(events(spark, 1), events(spark, 1), DAY), DAY, 62)


# sketches


def test_sketches_of_days_add_up(spark):
    feed, messages = events(spark, 60_000, 8, 30_000), events(spark, 20_000, 8, 30_000, seed=3)
    as_of = DAY + dt.timedelta(days=1)
    sketches = activity.daily_sketches(feed, messages, as_of, 8, ["source"])
    both = feed.select("user_id", "time", "source").unionByName(messages.select("user_id", "time", "source"))
    for days in (1, 3, 8):
        inside = both.where(F.col("time") >= F.lit(as_of - dt.timedelta(days=days)))
        exact = inside.agg(F.count_distinct("user_id")).first()[0]
        got = activity.users_of_sketches(sketches, as_of, days).first()["estimated_users"]
        assert exact > 5000 and abs(got - exact) <= exact * activity.SKETCH_ERROR
        by = activity.users_of_sketches(sketches, as_of, days, ["source"]).collect()
        assert len(by) == 2 and sum(r["estimated_users"] for r in by) > got  # users of both sources


# months of customers


def orders(spark, n, seed):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"order_id": np.arange(n) + seed * 10_000, "customer_id": rng.integers(0, 60, n)})
    frame["order_status"] = "delivered"
    frame["order_purchase_timestamp"] = pd.Timestamp("1999-11-03") + pd.to_timedelta(rng.integers(0, 4000, n), unit="D")
    frame["order_approved_at"] = frame["order_purchase_timestamp"]
    return spark.createDataFrame(frame)


def plain_cohorts(frame):
    month = frame["order_purchase_timestamp"].dt.to_period("M")
    pairs = pd.DataFrame({"c": frame["customer_id"] // 2, "m": month}).drop_duplicates()
    pairs["first"] = pairs.groupby("c")["m"].transform("min")
    found = pairs.groupby(["first", "m"]).size()
    return sorted((a.start_time.date(), b.start_time.date(), n, (b - a).n) for (a, b), n in found.items())


def test_months_merge(spark):
    customers = spark.range(60).selectExpr("id AS customer_id", "id div 2 AS customer_unique_id")
    lots = [orders(spark, 150, 1), orders(spark, 90, 2), orders(spark, 1, 3).limit(0)]
    state = None
    for lot in lots:
        state = cohorts.customer_months(customers, lot, state)
    got = cohorts.cohorts_of_months(state).select("cohort_group", "order_month", "unique_customers", "cohort_period")
    both = pd.concat([lot.toPandas() for lot in lots[:2]])
    assert sorted(map(tuple, got.collect())) == plain_cohorts(both)
    assert rows(cohorts.cohorts(customers, lots[0].unionByName(lots[1])).select(*got.columns), *got.columns) == rows(got, *got.columns)
    assert cohorts.cohorts(customers, lots[2]).count() == 0


def test_one_exchange_by_customer(spark):
    customers = spark.range(60).selectExpr("id AS customer_id", "id div 2 AS customer_unique_id")
    plan = cohorts.cohorts(customers, orders(spark, 50, 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(customer_unique_id") == 1 and "Window" not in plan
