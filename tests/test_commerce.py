"""Orders, cohorts and segments on small tables with known answers."""

import datetime as dt
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import exprs
from tidemark.operators import campaigns, cohorts, commerce, rfm
from tidemark.sources.fixtures import view

SF_DIR = "/root/testdata/sf0.01"
ORDERS = (
    "order_id int, customer_id int, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp"
)


def order(i, customer, at, status="delivered", approved=True):
    return (i, customer, status, at, at if approved else None)


def orders(spark, *made):
    return spark.createDataFrame(list(made), ORDERS)


def customers(spark, pairs):
    return spark.createDataFrame(pairs, "customer_id int, customer_unique_id string")


def at(month, day=1, hour=0, year=2024):
    return dt.datetime(year, month, day, hour)


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.0625,), (2.5,), (1.0015,), (None,)], "x double")
    got = [r[0] for r in df.select(exprs.round_even("x", 3)).collect()]
    assert got == [*np.round([0.0625, 2.5, 1.0015], 3), None]


def test_whole_days(spark):
    df = spark.createDataFrame([(at(1, 1, 23), at(1, 3, 1))], "a timestamp, b timestamp")
    assert df.select(exprs.whole_days("a", "b")).first()[0] == 1


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    assert {r.s for r in df.where(exprs.not_in("s", ["a", "b"])).collect()} == {"c", None}


def test_money_is_added_exactly(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1900.0001,)], "m double")
    assert df.select(exprs.money_sum("m")).first()[0] == 1901.0001
    assert df.limit(0).select(exprs.money_sum("m")).first()[0] == 0.0


def test_time_range_reaches_the_scan(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    kept = exprs.time_range(events, "ts", dt.date(2024, 1, 29), dt.date(2024, 1, 30)).select("user_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-29" in plan and "LessThan(ts,2024-01-30" in plan


def test_single_purchase_leaves_out_failed_orders(spark):
    people = customers(spark, [(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c"), (6, "d"), (7, None)])
    made = orders(
        spark,
        order(1, 1, at(1)),
        order(2, 2, at(1), "canceled"),
        order(3, 3, at(1)),
        order(4, 4, at(1), None),
        order(5, 5, at(1), approved=False),
        order(7, 7, at(1)),
    )
    assert commerce.single_purchase_customers(people, made).first()[0] == 1
    assert commerce.customers_total(people).first()[0] == 4


def test_undelivered_months(spark):
    made = orders(
        spark,
        *[order(i, i, at(1, i), "canceled") for i in range(1, 6)],
        order(6, 6, at(3), "canceled"),
        order(7, 7, at(3), "unavailable"),
        order(8, 8, at(3)),
    )
    monthly = commerce.undelivered_monthly(made)
    assert rows(commerce.undelivered_by_reason(monthly), "order_status") == [
        ("canceled", 3.0, 3.0),
        ("unavailable", 1.0, 1.0),
    ]


def test_weekday_ties_are_all_listed(spark):
    items = spark.createDataFrame(
        [(1, "x"), (1, "x"), (2, "x"), (1, "y"), (3, "y"), (4, "y"), (9, "z")],
        "order_id int, product_id string",
    )
    made = orders(
        spark,
        order(1, 1, at(1, 2)),  # Tuesday
        order(2, 2, at(1, 1)),  # Monday
        order(3, 3, at(1, 9)),
        order(4, 4, at(1, 1)),
    )
    got = dict(rows(commerce.product_weekday_mode(items, made), "product_id"))
    assert got == {"x": ["Monday", "Tuesday"], "y": ["Tuesday"], "z": []}


def test_orders_per_week(spark):
    people = customers(spark, [(1, "a"), (2, "a"), (3, "a")])
    made = orders(spark, order(1, 1, at(2, 3)), order(2, 2, at(2, 20)), order(3, 3, at(3)))
    weekly = commerce.orders_per_week(people, made)
    got = rows(commerce.customer_history(weekly, "a"), "month")
    assert [r[2:] for r in got] == [(2, 29, 4.14, 0.483), (1, 31, 4.43, 0.226)]


def test_history_is_chosen_before_the_join(spark):
    weekly = commerce.orders_per_week(view(spark, SF_DIR, "customers"), view(spark, SF_DIR, "orders_ds"))
    plan = commerce.customer_history(weekly, 57)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("= 57") > plan.index("Join")


def test_cohorts(spark):
    people = customers(spark, [(i, "abcd"[i % 4]) for i in range(8)] + [(9, "x")])
    made = orders(
        spark,
        *[order(i, i, at(1, 5)) for i in range(4)],
        order(4, 4, at(4, 2), "canceled"),  # every order counts
        order(6, 6, at(2, 2)),
    )
    table = cohorts.cohorts(people, made)
    got = rows(cohorts.cohort_retention(table), "cohort_period")
    assert [r[2:] for r in got] == [(4, 0, 4, 1.0), (1, 1, 4, 0.25), (1, 3, 4, 0.25)]
    best = cohorts.best_cohorts(cohorts.cohort_retention(table), 3).collect()
    assert [tuple(r) for r in best] == [(dt.date(2024, 1, 1), 4, 1, 0.25)]
    assert cohorts.best_cohorts(cohorts.cohort_retention(table), 3, year=2023).count() == 0
    assert cohorts.cohort_matrix(table).columns == ["cohort_group", "0", "1", "3"]
    assert cohorts.cohort_matrix(table, [0, 2]).first()["2"] is None


def test_period_zero_is_the_whole_cohort(spark):
    table = cohorts.cohorts(view(spark, SF_DIR, "customers"), view(spark, SF_DIR, "orders_ds"))
    start = cohorts.cohort_retention(table).where("cohort_period = 0")
    assert start.where("retention <> 1").count() == 0
    assert start.count() == table.select("cohort_group").distinct().count()


def test_matrix_holds_the_whole_table(spark):
    table = cohorts.cohorts(view(spark, SF_DIR, "customers"), view(spark, SF_DIR, "orders_ds"))
    wide = cohorts.cohort_matrix(table)
    periods = wide.columns[1:]
    back = wide.unpivot("cohort_group", periods, "period", "n").where("n is not null")
    found = {(g, int(p), int(n)) for g, p, n in back.collect()}
    assert found == {
        (r.cohort_group, r.cohort_period, r.unique_customers) for r in table.collect()
    }


def pandas_rfm(people, made, items):
    good = made[made.order_approved_at.notnull() & ~made.order_status.isin(["canceled", "unavailable"])]
    price = items.groupby("order_id", as_index=False).price.sum()
    both = people.merge(good, on="customer_id").merge(price, how="left", on="order_id")
    now = both.order_purchase_timestamp.max() + pd.Timedelta(days=1)
    both["days"] = (now - both.order_purchase_timestamp).dt.days
    return both.groupby("customer_unique_id").agg(
        recency=("days", "min"), frequency=("order_id", "count"), monetary=("price", "sum")
    )


def test_rfm_equals_pandas(spark):
    tables = [view(spark, SF_DIR, n) for n in ("customers", "orders_ds", "order_items")]
    wanted = pandas_rfm(*[t.toPandas() for t in tables])
    base = rfm.staged_base(*tables)
    got = base.toPandas().set_index("customer_unique_id").loc[wanted.index]
    assert (got.recency == wanted.recency).all() and (got.frequency == wanted.frequency).all()
    assert np.allclose(got.monetary, wanted.monetary, rtol=1e-12)
    bounds = rfm.rfm_quintiles(base).toPandas().set_index("quantile")
    for name in ("recency", "frequency", "monetary"):
        assert np.allclose(bounds[name], got[name].quantile([0.2, 0.4, 0.6, 0.8]), rtol=1e-12)


def test_every_customer_has_one_known_segment(spark):
    tables = [view(spark, SF_DIR, n) for n in ("customers", "orders_ds", "order_items")]
    scored = rfm.rfm(rfm.staged_base(*tables))
    assert scored.count() == scored.select("customer_unique_id").distinct().count()
    assert scored.where(~F.col("segment").isin(*rfm.SEGMENTS.values())).count() == 0
    shares = rfm.segment_share(scored).collect()
    assert sum(r.customers for r in shares) == scored.count()
    assert [r.customers for r in shares] == sorted(r.customers for r in shares)


def test_all_score_pairs_have_a_segment():
    for pair in (f"{r}{f}" for r in range(1, 6) for f in range(1, 4)):
        hits = [name for p, name in rfm.SEGMENTS.items() if re.fullmatch(p, pair)]
        assert len(hits) == 1, pair


def test_rfm_without_prices(spark):
    people = customers(spark, [(1, "a"), (2, "b")])
    made = orders(spark, order(1, 1, at(1, 1, 12)), order(2, 2, at(1, 3)))
    items = spark.createDataFrame([(2, 5.0), (2, 2.5)], "order_id int, price double")
    got = rows(rfm.staged_base(people, made, items), "customer_unique_id")
    assert got == [("a", 2, 1, 0.0), ("b", 1, 1, 7.5)]


CAMPAIGNS = [
    # id, geo, buyer, impressions, clicks, installs, registrations, spend, ad, in app
    (1, "x", "p", 1000, 10, 5, 2, 20.0, 30.0, 10.0),
    (2, "x", "q", 1000, 50, 0, 0, 10.0, 5.0, 0.0),
    (3, "y", "q", 0, 0, 4, 4, 0.0, 0.0, 0.0),
    (4, "y", "p", 100, 5, 2, 1, 10.0, 0.0, 10.0),
]


def campaign_table(spark):
    names = ["Campaign_id", "Geo", "Buyer", *campaigns.TOTALS]
    return spark.createDataFrame(CAMPAIGNS, names)


def test_campaign_metrics_without_denominators(spark):
    got = {r.Campaign_id: r for r in campaigns.campaign_metrics(campaign_table(spark)).collect()}
    assert (got[1].CTR, got[1].CPI, got[1].CR_regist, got[1].CPO_30d, got[1].ROI_30d) == (
        0.01,
        4.0,
        0.4,
        0.5,
        100.0,
    )
    assert got[2].CPI is None and got[3].CTR is None and got[3].ROI_30d is None


def test_top_campaigns_put_missing_values_last(spark):
    metrics = campaigns.campaign_metrics(campaign_table(spark))
    ids = lambda *a, **k: [r[0] for r in campaigns.top_campaigns(metrics, *a, **k).collect()]
    assert ids("CTR") == [2, 4, 1, 3]
    assert ids("CPI", ascending=True) == [3, 1, 4, 2]
    assert ids("ROI_30d", n=2) == [1, 4]


def test_group_ratios_come_from_totals(spark):
    got = {r.Geo: r for r in campaigns.group_metrics(campaign_table(spark), "Geo").collect()}
    assert got["x"].CTR == 60 / 2000 and got["x"].CPI == 30 / 5
    assert got["y"].ROI_30d == 0.0
    assert [r.Buyer for r in campaigns.buyer_ranking(campaign_table(spark)).collect()] == ["p", "q"]
