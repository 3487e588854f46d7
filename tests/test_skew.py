"""Tables in which one user, quarter of an hour, customer key and product hold a third of all rows."""

import duckdb
import pytest

from check_oracle import compare

TABLES = {
    "customer": "SELECT range AS c_custkey FROM range(1, 20001)",
    "events": """
        SELECT event_id, event_type, value,
               CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-29 10:00:00' + INTERVAL (event_id % 800) SECOND
                    ELSE TIMESTAMP '2024-01-01' + INTERVAL (hash(event_id) % 2591990) SECOND END AS ts,
               CASE WHEN event_id % 10 < 3 THEN 7 ELSE CAST(hash(event_id + 1) % 9000 AS BIGINT) END AS user_id
        FROM (SELECT range AS event_id, range / 4 % 1000 AS value,
                     (['error', 'click', 'view', 'purchase', 'signup'])[1 + range % 5] AS event_type
              FROM range(150000))""",
    "orders": """
        SELECT range AS o_orderkey, TIMESTAMP '1995-01-01' + INTERVAL (hash(range) % 2403) DAY AS o_orderdate,
               CASE WHEN range % 3 = 0 THEN 1 ELSE CAST(1 + hash(range + 1) % 19999 AS BIGINT) END AS o_custkey
        FROM range(1, 60001)""",
    "lineitem": """
        SELECT CASE WHEN range % 7 < 2 THEN 11 ELSE CAST(1 + hash(range) % 60000 AS BIGINT) END AS l_orderkey,
               CASE WHEN range % 3 = 0 THEN 5 ELSE CAST(1 + hash(range + 1) % 2000 AS BIGINT) END AS l_partkey,
               (900 + hash(range + 2) % 10000000) / 100 AS l_extendedprice,
               TIMESTAMP '1995-02-01' AS l_shipdate
        FROM range(200000)""",
}
QUERIES = [
    "feed_user_daily",
    "message_user_daily",
    "action_comb",
    "daily_slices",
    "daily_summary",
    "dau_by_source",
    "app_retention",
    "alert_feed_buckets",
    "anomaly_bands",
    "single_purchase_customers",
    "product_weekday_mode",
    "orders_per_week",
    "cohorts",
    "rfm",
    "ab_group_metrics",
    "mann_whitney",
    "funnel_metrics",
    "stream_message_buckets",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name, text in TABLES.items():
        con.execute(f"COPY ({text}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    yield folder, con
    con.close()


@pytest.fixture(scope="module")
def small_limits(spark):
    """No broadcasts, and skew splitting from a few kilobytes on."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(spark, skewed, small_limits, name):
    folder, con = skewed
    assert compare(spark, con, name, folder) is None
