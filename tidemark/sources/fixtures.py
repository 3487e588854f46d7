"""Views that give the test tables the shape of the product's tables.

The text runs in Spark and in DuckDB; ``{name}`` stands for a table. All derived attributes are
arithmetic on ids, so both sides agree exactly.
"""

from __future__ import annotations

import datetime as dt
import functools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

AS_OF = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 1, 30, 18, 7)
CUSTOMER = 57  # the customer whose history is shown

_ATTRIBUTES = """user_id % 2 AS gender, 15 + user_id % 40 AS age,
       CASE WHEN user_id % 11 = 0 THEN NULL
            WHEN (user_id + CASE WHEN user_id % 7 = 0 THEN event_id ELSE 0 END) % 3 = 0 THEN 'iOS'
            ELSE 'Android' END AS os,
       CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source"""
# for retention only: every fourth user starts late in the month, so that some are new in the last week
_STARTED = "extract(DAY FROM ts) > CASE WHEN user_id % 4 = 0 THEN user_id % 30 ELSE 0 END"
_SUBJECT = """CASE WHEN event_id % 3 = 0 THEN 'Math' WHEN event_id % 3 = 1 THEN 'Physics'
            ELSE 'Chemistry' END AS subject"""

VIEWS = {
    "feed_actions": f"""
SELECT user_id, ts AS time, CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
       {_ATTRIBUTES}
FROM {{events}} WHERE event_type IN ('view', 'click')""",
    "message_actions": f"""
SELECT user_id, (user_id * 7 + event_id) % 150 AS reciever_id, ts AS time,
       {_ATTRIBUTES}
FROM {{events}} WHERE event_type IN ('signup', 'error', 'purchase')""",
    "started_feed": f"SELECT user_id, ts AS time FROM {{events}} WHERE event_type IN ('view', 'click') AND {_STARTED}",
    "started_messages": f"""
SELECT user_id, ts AS time FROM {{events}} WHERE event_type IN ('signup', 'error', 'purchase') AND {_STARTED}""",
    "nation_revenue": """
SELECT r_name AS region, n_name AS nation, sum(o_totalprice) AS revenue
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
     JOIN {region} ON n_regionkey = r_regionkey
GROUP BY r_name, n_name""",
    "event_values": "SELECT event_type, value FROM {events} WHERE event_type IN ('view', 'click')",
    "peas": f"""
SELECT user_id AS st_id, ts AS timest, event_id % 4 = 0 AS correct, {_SUBJECT}
FROM {{events}}""",
    "studs": """
SELECT DISTINCT user_id AS st_id, CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'pilot' END AS test_grp
FROM {events} WHERE user_id % 10 <> 9""",
    "final_project_check": f"""
SELECT user_id AS st_id, ts AS sale_time, value AS money, {_SUBJECT}
FROM {{events}} WHERE event_type = 'purchase'""",
    "customers": """
SELECT o_orderkey AS customer_id, o_custkey * 8 + o_orderkey % 8 AS customer_unique_id FROM {orders}
UNION ALL SELECT -c_custkey, -c_custkey FROM {customer} WHERE c_custkey % 50 = 0""",
    "orders_ds": """
SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
       CASE WHEN o_orderkey % 20 = 0 THEN 'canceled' WHEN o_orderkey % 20 = 1 THEN 'unavailable'
            ELSE 'delivered' END AS order_status,
       o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' DAY END AS order_approved_at
FROM {orders}""",
    "order_items": """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
       l_shipdate AS shipping_limit_date
FROM {lineitem}""",
    "groups": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'A' ELSE 'B' END AS grp
FROM {customer} WHERE c_custkey % 20 <> 0""",
    "groups_add": """
SELECT c_custkey AS user_no, CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE 'B' END AS variant
FROM {customer} WHERE c_custkey % 20 = 0""",
    "active_studs": "SELECT c_custkey AS student_id FROM {customer} WHERE c_custkey % 9 < 3",
    "checks": """
SELECT c_custkey AS student_id, CAST(190 + (c_custkey % 7) * 100 AS DOUBLE) AS rev
FROM {customer} WHERE c_custkey % 13 = 0""",
    "repeated_checks": """
SELECT c_custkey AS student_id, CAST(190 + (c_custkey % 7) * 100 AS DOUBLE) AS rev
FROM {customer} WHERE c_custkey % 13 = 0
UNION ALL SELECT c_custkey, CAST(190 + (c_custkey % 7) * 100 AS DOUBLE)
FROM {customer} WHERE c_custkey % 39 = 0""",
    "campaigns": """
SELECT l_suppkey AS campaign_id, r_name AS geo,
       concat('buyer_', CAST(s_suppkey % 5 + 1 AS STRING)) AS buyer,
       sum(l_quantity) * 100 AS impressions, sum(l_quantity) AS clicks, count(*) AS installs,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS registrations,
       sum(l_extendedprice * l_discount) AS spend, sum(l_extendedprice * l_tax) AS revenue_ad30d,
       sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END) * 0.05 AS revenue_in_app30d
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
     JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
GROUP BY l_suppkey, r_name, s_suppkey""",
}
# the feed with a burst of views in the last closed quarter of an hour
VIEWS["feed_burst"] = f"""{VIEWS["feed_actions"]}
UNION ALL SELECT user_id, CAST('2024-01-30 17:50:00' AS TIMESTAMP) AS time, 'view' AS action,
       {_ATTRIBUTES}
FROM {{events}} WHERE event_type = 'view' AND user_id % 5 = 0"""


def tables_of(view: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[view])))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir}/{table}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


@functools.cache
def _schema(spark: SparkSession, path: str) -> StructType:
    """The schema in the files, looked up once, since each query makes several views of a table."""
    return spark.read.parquet(path).schema


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the Parquet tables in ``sf_dir``."""
    tables = {t: read(spark, sf_dir, t) for t in tables_of(name)}
    return spark.sql(VIEWS[name], **tables)


def with_views(sql: str, *names: str) -> str:
    """``sql`` with the named views in front, for a database that has the plain tables."""
    parts = []
    for name in names:
        body = VIEWS[name].format(**{t: t for t in tables_of(name)})
        parts.append(f"{name} AS ({body})")
    joint = ",\n".join(parts)
    for word in ("WITH RECURSIVE ", "WITH "):
        if sql.lstrip().upper().startswith(word):
            return f"{word}{joint},\n{sql.lstrip()[len(word):]}"
    return f"WITH {joint}\n{sql}"
