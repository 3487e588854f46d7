"""The registered queries in plain SQL, for a database that holds the test tables."""

from __future__ import annotations

from tidemark.functions import draws
from tidemark.sources.fixtures import CUSTOMER, with_views

SQL: dict[str, str] = {}


def sql(name: str, views: str, text: str) -> None:
    SQL[name] = with_views(text.strip(), *views.split())


def day(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {alias or column}"


def moment(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {alias or column}"


def chain(*parts: str) -> str:
    return ",\n".join(p.strip() for p in parts)


FEED, MESSAGES = "feed_actions", "message_actions"
BOTH = f"{FEED} {MESSAGES}"
YESTERDAY = "time >= DATE '2024-01-29' AND time < DATE '2024-01-30'"
WEEK = "time >= DATE '2024-01-23' AND time < DATE '2024-01-30'"
CLOSED = "time >= DATE '2024-01-29' AND time < TIMESTAMP '2024-01-30 18:00:00'"

# sources and sinks

sql("read_semicolon", "checks", "SELECT student_id, round(rev, 6) AS rev FROM checks")

sql(
    "read_decimal_comma",
    "campaigns",
    """SELECT campaign_id, geo, buyer, CAST(installs AS BIGINT) AS installs,
       CAST(registrations AS BIGINT) AS registrations, round(spend, 4) AS spend FROM campaigns""",
)

ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
]
sql(
    "profile_nulls",
    "orders_ds",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM orders_ds"
        for c in ORDER_COLUMNS
    ),
)

# daily activity

FEED_DAILY = f"""
feed_daily AS (
  SELECT user_id, CAST(time AS DATE) AS event_date, gender, age, os,
         count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'view') AS views
  FROM feed_actions WHERE {YESTERDAY} GROUP BY ALL)"""

MESSAGE_SIDES = f"""
sent AS (
  SELECT user_id, CAST(time AS DATE) AS event_date, gender, age, os,
         count(*) AS messages_sent, count(DISTINCT reciever_id) AS users_sent
  FROM message_actions WHERE {YESTERDAY} GROUP BY ALL),
received AS (
  SELECT reciever_id AS user_id, CAST(time AS DATE) AS event_date,
         count(*) AS messages_received, count(DISTINCT user_id) AS users_received
  FROM message_actions WHERE {YESTERDAY} GROUP BY ALL)"""

MESSAGE_DAILY = f"""{MESSAGE_SIDES},
homes AS (
  SELECT user_id, event_date, gender, age, os,
         row_number() OVER (PARTITION BY user_id, event_date ORDER BY own DESC, n DESC, gender DESC NULLS LAST,
                            age DESC NULLS LAST, os DESC NULLS LAST) AS place
  FROM (SELECT user_id, event_date, gender, age, os, 1 AS own, messages_sent AS n FROM sent
        UNION ALL SELECT user_id, event_date, gender, age, os, 0, likes + views FROM feed_daily)),
at_home AS (
  SELECT r.user_id, r.event_date, gender, age, os, messages_received, users_received
  FROM received r LEFT JOIN homes h ON r.user_id = h.user_id AND r.event_date = h.event_date AND place = 1),
message_daily AS (
  SELECT coalesce(s.user_id, r.user_id) AS user_id, coalesce(s.event_date, r.event_date) AS event_date,
         coalesce(s.gender, r.gender) AS gender, coalesce(s.age, r.age) AS age, coalesce(s.os, r.os) AS os,
         messages_sent, messages_received, users_sent, users_received
  FROM sent s FULL JOIN at_home r
    ON s.user_id = r.user_id AND s.event_date = r.event_date AND s.gender IS NOT DISTINCT FROM r.gender
       AND s.age IS NOT DISTINCT FROM r.age AND s.os IS NOT DISTINCT FROM r.os)"""

MESSAGE_LITERAL = f"""{MESSAGE_SIDES},
message_daily AS (
  SELECT s.user_id, s.event_date, gender, age, os, messages_sent, messages_received, users_sent,
         CAST(CASE WHEN r.user_id IS NOT NULL THEN 1 END AS BIGINT) AS users_received
  FROM sent s LEFT JOIN received r ON s.user_id = r.user_id)"""

COMBINED = """
combined AS (
  SELECT coalesce(f.user_id, m.user_id) AS user_id, coalesce(f.event_date, m.event_date) AS event_date,
         coalesce(f.gender, m.gender) AS gender, coalesce(f.age, m.age) AS age,
         coalesce(f.os, m.os) AS os, likes, views,
         messages_sent, messages_received, users_sent, users_received
  FROM feed_daily f FULL JOIN message_daily m
    ON f.user_id = m.user_id AND f.event_date = m.event_date AND f.gender IS NOT DISTINCT FROM m.gender
       AND f.age IS NOT DISTINCT FROM m.age AND f.os IS NOT DISTINCT FROM m.os)"""

USER_DAY = f"user_id, {day('event_date')}, CAST(gender AS BIGINT) AS gender, CAST(age AS BIGINT) AS age, os"
MESSAGE_COUNTS = "messages_sent, messages_received, users_sent, users_received"

sql(
    "feed_user_daily",
    FEED,
    f"WITH {FEED_DAILY.strip()} SELECT {USER_DAY}, likes, views FROM feed_daily",
)
sql(
    "message_user_daily",
    BOTH,
    f"WITH {chain(FEED_DAILY, MESSAGE_DAILY)} SELECT {USER_DAY}, {MESSAGE_COUNTS} FROM message_daily",
)
sql(
    "message_user_daily_literal",
    MESSAGES,
    f"WITH {MESSAGE_LITERAL.strip()} SELECT {USER_DAY}, {MESSAGE_COUNTS} FROM message_daily",
)
sql(
    "action_comb",
    BOTH,
    f"WITH {chain(FEED_DAILY, MESSAGE_DAILY, COMBINED)} "
    f"SELECT {USER_DAY}, likes, views, {MESSAGE_COUNTS} FROM combined",
)

SLICE_METRICS = [
    "views",
    "likes",
    "messages_received",
    "messages_sent",
    "users_received",
    "users_sent",
]
SLICES = "\nUNION ALL ".join(
    f"SELECT {day('event_date')}, '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value, "
    + ", ".join(f"CAST(coalesce(sum({m}), 0) AS DOUBLE) AS {m}" for m in SLICE_METRICS)
    + f" FROM combined WHERE {d} IS NOT NULL GROUP BY event_date, {d}"
    for d in ("gender", "os", "age")
)
for key in ("daily_slices", "daily_slice_sink"):
    sql(key, BOTH, f"WITH {chain(FEED_DAILY, MESSAGE_DAILY, COMBINED)} {SLICES}")
sql("daily_slices_literal", BOTH, f"WITH {chain(FEED_DAILY, MESSAGE_LITERAL, COMBINED)} {SLICES}")

sql(
    "daily_summary",
    BOTH,
    f"""SELECT '2024-01-29' AS date, likes, views, round_even(likes / nullif(views, 0), 3) AS ctr, messages, dau
FROM (SELECT count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'view') AS views
      FROM feed_actions WHERE {YESTERDAY}),
     (SELECT count(user_id) AS messages FROM message_actions WHERE {YESTERDAY}),
     (SELECT count(DISTINCT user_id) AS dau
      FROM (SELECT user_id, time FROM feed_actions UNION ALL SELECT user_id, time FROM message_actions)
      WHERE {YESTERDAY})""",
)
sql(
    "feed_week",
    FEED,
    f"""SELECT {day('time', 'date')}, count(*) FILTER (action = 'view') AS views,
       count(*) FILTER (action = 'like') AS likes,
       round_even(count(*) FILTER (action = 'like') / nullif(count(*) FILTER (action = 'view'), 0), 3) AS ctr
FROM feed_actions WHERE {WEEK} GROUP BY 1""",
)
for key, when in (("messages_daily", YESTERDAY), ("messages_week", WEEK)):
    sql(
        key,
        MESSAGES,
        f"SELECT {day('time', 'date')}, count(user_id) AS messages FROM message_actions WHERE {when} GROUP BY 1",
    )

ACTIVITY = """(SELECT user_id, time, source FROM feed_actions
      UNION ALL SELECT user_id, time, source FROM message_actions)"""
sql(
    "dau_yesterday",
    BOTH,
    f"""SELECT {day('time', 'date')}, count(DISTINCT user_id) AS unique_users
FROM {ACTIVITY} WHERE {YESTERDAY} GROUP BY 1""",
)
sql(
    "dau_by_source",
    BOTH,
    f"""SELECT {day('time', 'date')}, source, count(DISTINCT user_id) AS unique_users
FROM {ACTIVITY} WHERE {WEEK} GROUP BY 1, 2""",
)

STARTED = "started_feed started_messages"
RETENTION = """
active AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day
           FROM (SELECT * FROM started_feed UNION ALL SELECT * FROM started_messages)),
starts AS (SELECT user_id, min(day) AS start_day FROM active GROUP BY user_id),
kept AS (
  SELECT start_day, day, count(user_id) AS users FROM starts JOIN active USING (user_id)
  WHERE start_day >= DATE '2024-01-23' GROUP BY start_day, day)"""
sql(
    "app_retention",
    STARTED,
    f"WITH {RETENTION.strip()} SELECT {day('start_day')}, {day('day')}, users FROM kept",
)
SQL["app_retention_90"] = SQL["app_retention"].replace("DATE '2024-01-23'", "DATE '2023-11-01'")
SQL["retention_incremental"] = SQL["app_retention"]
sql(
    "dau_sketch_rollup",
    "feed_actions message_actions",
    """WITH everything AS (
  SELECT user_id, time, source FROM feed_actions UNION ALL SELECT user_id, time, source FROM message_actions)
SELECT days, source, count(DISTINCT user_id) AS users, true AS agrees
FROM everything, (VALUES (1), (7), (30)) spans(days)
WHERE time < DATE '2024-01-30' AND time >= DATE '2024-01-30' - CAST(days AS INT)
GROUP BY days, source""",
)
DAYS = [f"2024-01-{d}" for d in range(23, 31)]
sql(
    "app_retention_pivot",
    STARTED,
    f"WITH {RETENTION.strip()} SELECT {day('start_day')}, "
    + ", ".join(f"CAST(max(users) FILTER (day = DATE '{d}') AS DOUBLE) AS \"{d}\"" for d in DAYS)
    + " FROM kept GROUP BY start_day",
)

# alerts

FEED_BUCKETS = f"""
buckets AS (
  SELECT time_bucket(INTERVAL '15 minutes', time) AS ts, count(DISTINCT user_id) AS users_feed,
         count(user_id) FILTER (action = 'like') AS likes, count(user_id) FILTER (action = 'view') AS views,
         round_even(count(user_id) FILTER (action = 'like')
                    / nullif(count(user_id) FILTER (action = 'view'), 0), 3) AS ctr
  FROM feed_actions WHERE {CLOSED} GROUP BY 1)"""
MESSAGE_BUCKETS = f"""
buckets AS (
  SELECT time_bucket(INTERVAL '15 minutes', time) AS ts, count(DISTINCT user_id) AS users_message,
         count(user_id) AS messages
  FROM message_actions WHERE {CLOSED} GROUP BY 1)"""
LABELS = f"{moment('ts')}, {day('ts', 'date')}, strftime(ts, '%H:%M') AS hm"

sql(
    "alert_feed_buckets",
    FEED,
    f"WITH {FEED_BUCKETS.strip()} SELECT {LABELS}, users_feed, likes, views, ctr FROM buckets",
)
sql(
    "alert_message_buckets",
    MESSAGES,
    f"WITH {MESSAGE_BUCKETS.strip()} SELECT {LABELS}, users_message, messages FROM buckets",
)
sql(
    "alert_feed_buckets_filled",
    FEED,
    f"""WITH {FEED_BUCKETS.strip()},
every AS (SELECT unnest(generate_series((SELECT min(ts) FROM buckets), (SELECT max(ts) FROM buckets),
                                        INTERVAL '15 minutes')) AS ts)
SELECT {LABELS}, users_feed, likes, views, ctr FROM every LEFT JOIN buckets USING (ts)""",
)


def bands(metrics: list[str], needed: int) -> str:
    long = " UNION ALL ".join(
        f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM buckets" for m in metrics
    )
    return f"""
long AS ({long}),
quartiles AS (
  SELECT *, lag(value) OVER line AS previous,
         CASE WHEN count(value) OVER before = 5 THEN quantile_cont(value, 0.25) OVER before END AS q25,
         CASE WHEN count(value) OVER before = 5 THEN quantile_cont(value, 0.75) OVER before END AS q75
  FROM long WINDOW line AS (PARTITION BY metric ORDER BY ts),
       before AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
raw AS (SELECT *, q75 - q25 AS iqr, q75 + 4 * (q75 - q25) AS h, q25 - 4 * (q75 - q25) AS l FROM quartiles),
bands AS (
  SELECT *, CASE WHEN count(h) OVER around >= {needed} THEN avg(h) OVER around END AS high,
         CASE WHEN count(l) OVER around >= {needed} THEN avg(l) OVER around END AS low
  FROM raw WINDOW around AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))"""


FEED_METRICS = ["users_feed", "views", "likes", "ctr"]
BAND_COLUMNS = f"{moment('ts')}, metric, value, previous, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ("q25", "q75", "iqr", "high", "low")
)
for key, needed in (("anomaly_bands", 1), ("anomaly_bands_strict", 5)):
    sql(
        key,
        FEED,
        f"WITH {chain(FEED_BUCKETS, bands(FEED_METRICS, needed))} SELECT {BAND_COLUMNS} FROM bands",
    )

CHECKS = f"""
latest AS (
  SELECT *, 1 - value / nullif(previous, 0) AS change,
         coalesce(value < low OR value > high, false) AS is_alert,
         row_number() OVER (PARTITION BY metric ORDER BY ts DESC) AS place FROM bands),
checked AS (
  SELECT metric, {moment('ts')}, value, previous, round(low, 6) AS low, round(high, 6) AS high,
         round(change, 6) AS change, is_alert,
         'Метрика ' || metric || ':' || chr(10) || 'текущее значение '
         || coalesce(printf('%.2f', value), '-') || chr(10) || 'отклонение от предыдущего значения '
         || coalesce(printf('%.2f', change * 100) || '%', '-') AS text
  FROM latest WHERE place = 1)"""
for key in ("anomaly_latest", "stream_alerts"):
    sql(
        key,
        FEED,
        f"WITH {chain(FEED_BUCKETS, bands(FEED_METRICS, 1), CHECKS)} SELECT * FROM checked",
    )
MESSAGE_METRICS = ["users_message", "messages"]
sql(
    "anomaly_latest_messages",
    MESSAGES,
    f"WITH {chain(MESSAGE_BUCKETS, bands(MESSAGE_METRICS, 1), CHECKS)} SELECT * FROM checked",
)
ALERT_ROWS = "SELECT * FROM ({}) WHERE is_alert UNION ALL SELECT * FROM ({}) WHERE is_alert"
BURST = f"WITH {chain(FEED_BUCKETS, bands(FEED_METRICS, 1), CHECKS)} SELECT * FROM checked"
BURST = with_views(BURST.replace("feed_actions", "feed_burst"), "feed_burst")
SQL["alert_rows"] = ALERT_ROWS.format(BURST, SQL["anomaly_latest_messages"])

# streams: the watermark is the newest event, so the buckets that ended by then are closed

ALL_FEED_BUCKETS = FEED_BUCKETS.replace(f" WHERE {CLOSED}", "")
ALL_MESSAGE_BUCKETS = MESSAGE_BUCKETS.replace(f" WHERE {CLOSED}", "")
for key, view, buckets, metrics in (
    ("stream_alert_buckets", FEED, ALL_FEED_BUCKETS, "users_feed, likes, views, ctr"),
    ("stream_message_buckets", MESSAGES, ALL_MESSAGE_BUCKETS, "users_message, messages"),
):
    sql(
        key,
        view,
        f"""WITH {buckets.strip()} SELECT {LABELS}, {metrics} FROM buckets
WHERE ts + INTERVAL '15 minutes' <= (SELECT max(time) FROM {view})""",
    )

sql("stream_late_buckets", FEED, f"WITH {ALL_FEED_BUCKETS.strip()} SELECT {LABELS}, users_feed, likes, views, ctr FROM buckets")

LONG_BUCKETS = " UNION ALL ".join(
    f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM closed" for m in FEED_METRICS
)
sql(
    "stream_alerts_stateful",
    FEED,
    f"""WITH {ALL_FEED_BUCKETS.strip()},
closed AS (SELECT * FROM buckets WHERE ts + INTERVAL '15 minutes' <= (SELECT max(time) FROM feed_actions)),
long AS ({LONG_BUCKETS}),
quartiles AS (
  SELECT *, lag(value) OVER line AS previous, count(value) OVER earlier AS seen,
         quantile_cont(value, 0.25) OVER earlier AS q25, quantile_cont(value, 0.75) OVER earlier AS q75
  FROM long
  WINDOW line AS (PARTITION BY metric ORDER BY ts),
         earlier AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
bounds AS (
  SELECT *, CASE WHEN seen = 5 THEN q25 - 4 * (q75 - q25) END AS raw_low,
         CASE WHEN seen = 5 THEN q75 + 4 * (q75 - q25) END AS raw_high FROM quartiles),
smooth AS (
  SELECT *, avg(raw_low) OVER upto AS low, avg(raw_high) OVER upto AS high FROM bounds
  WINDOW upto AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT metric, {moment('ts')}, value, previous, round(low, 6) AS low, round(high, 6) AS high,
       round(1 - value / nullif(previous, 0), 6) AS change, coalesce(value < low OR value > high, false) AS is_alert
FROM smooth""",
)

# advertising

RATIOS = """clicks / nullif(impressions, 0) AS CTR, spend / nullif(installs, 0) AS CPI,
  registrations / nullif(installs, 0) AS CR_regist,
  spend / nullif(revenue_ad30d + revenue_in_app30d, 0) AS CPO_30d,
  (revenue_ad30d + revenue_in_app30d - spend) / nullif(spend, 0) * 100 AS ROI_30d,
  revenue_ad30d + revenue_in_app30d AS Revenue_30d"""
ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in ("CTR", "CPI", "CR_regist", "CPO_30d", "ROI_30d"))
RATED = f"WITH rated AS (SELECT *, {RATIOS} FROM campaigns)"
IDS = 'campaign_id AS "Campaign_id", geo AS "Geo", buyer AS "Buyer"'

sql(
    "campaign_metrics",
    "campaigns",
    f"{RATED} SELECT {IDS}, round(Revenue_30d, 4) AS Revenue_30d, {ROUNDED} FROM rated",
)
for key, metric, order in (("ctr", "CTR", "DESC"), ("cpi", "CPI", "ASC"), ("roi", "ROI_30d", "DESC")):
    sql(
        f"top_campaigns_{key}",
        "campaigns",
        f"""{RATED} SELECT {IDS}, round({metric}, 6) AS {metric} FROM rated
ORDER BY rated.{metric} {order} NULLS LAST, campaign_id LIMIT 5""",
    )
for key, by, name in (("geo_metrics", "geo", "Geo"), ("buyer_metrics", "buyer", "Buyer")):
    sql(
        key,
        "campaigns",
        f"""WITH totals AS (
  SELECT {by}, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(installs) AS installs,
         sum(registrations) AS registrations, sum(spend) AS spend, sum(revenue_ad30d) AS revenue_ad30d,
         sum(revenue_in_app30d) AS revenue_in_app30d
  FROM campaigns GROUP BY {by}),
rated AS (SELECT *, {RATIOS} FROM totals)
SELECT {by} AS "{name}", CAST(impressions AS DOUBLE) AS "Impressions", CAST(clicks AS DOUBLE) AS "Clicks",
       CAST(installs AS BIGINT) AS "Installs", CAST(registrations AS BIGINT) AS "Registrations",
       round(spend, 4) AS "Spend", round(revenue_ad30d, 4) AS "Revenue_ad30d",
       round(revenue_in_app30d, 4) AS "Revenue_in_app30d", round(Revenue_30d, 4) AS Revenue_30d, {ROUNDED}
FROM rated""",
    )

# shop

SUCCESSFUL = """order_approved_at IS NOT NULL
       AND coalesce(order_status NOT IN ('canceled', 'unavailable'), true)"""
sql(
    "single_purchase_customers",
    "customers orders_ds",
    f"""SELECT count(*) AS customers FROM (
  SELECT customer_unique_id FROM customers
  WHERE customer_id IN (SELECT customer_id FROM orders_ds WHERE {SUCCESSFUL})
  GROUP BY customer_unique_id HAVING count(customer_id) = 1)""",
)
sql(
    "customers_total",
    "customers",
    "SELECT count(DISTINCT customer_unique_id) AS customers FROM customers",
)
UNDELIVERED = """monthly AS (
  SELECT order_status, date_trunc('month', order_purchase_timestamp) AS month, count(order_id) AS orders
  FROM orders_ds WHERE order_status IN ('canceled', 'unavailable') GROUP BY ALL)"""
sql(
    "undelivered_monthly",
    "orders_ds",
    f"""WITH {UNDELIVERED} SELECT order_status, {day('month')}, orders,
       strftime(month, '%Y-%m') AS label FROM monthly""",
)
sql(
    "undelivered_by_reason",
    "orders_ds",
    f"""WITH {UNDELIVERED} SELECT order_status, round(avg(orders), 6) AS mean_orders,
       CAST(median(orders) AS DOUBLE) AS median_orders FROM monthly GROUP BY order_status""",
)
sql(
    "product_weekday_mode",
    "order_items orders_ds",
    """WITH once AS (SELECT DISTINCT order_id, product_id FROM order_items),
counts AS (
  SELECT product_id, dayname(order_purchase_timestamp) AS name, count(*) AS n
  FROM once LEFT JOIN orders_ds USING (order_id) GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY product_id ORDER BY n DESC) AS place FROM counts)
SELECT product_id, string_agg(name, ',' ORDER BY name) AS day_of_week
FROM ranked WHERE place = 1 GROUP BY product_id""",
)
PER_WEEK = f"""weekly AS (
  SELECT customer_unique_id, date_trunc('month', order_purchase_timestamp) AS month,
         count(order_id) AS count_orders
  FROM customers JOIN orders_ds USING (customer_id) WHERE {SUCCESSFUL} GROUP BY ALL),
weeks AS (
  SELECT *, day(last_day(month)) AS count_of_days, round_even(day(last_day(month)) / 7, 2) AS count_of_weeks
  FROM weekly)"""
PER_WEEK_COLUMNS = f"""customer_unique_id, {day('month')}, count_orders,
       CAST(count_of_days AS BIGINT) AS count_of_days, count_of_weeks,
       round_even(count_orders / count_of_weeks, 3) AS avg_orders_by_week"""
sql(
    "orders_per_week",
    "customers orders_ds",
    f"WITH {PER_WEEK} SELECT {PER_WEEK_COLUMNS} FROM weeks",
)
sql(
    "customer_history",
    "customers orders_ds",
    f"WITH {PER_WEEK} SELECT {PER_WEEK_COLUMNS} FROM weeks WHERE customer_unique_id = {CUSTOMER}",
)
SQL["customer_history_lookup"] = SQL["customer_history"]
sql(
    "order_span",
    "customers orders_ds",
    f"""SELECT {moment('min(order_purchase_timestamp)', 'first_order')},
       {moment('max(order_purchase_timestamp)', 'last_order')},
       date_sub('second', min(order_purchase_timestamp), max(order_purchase_timestamp)) AS span_seconds
FROM customers JOIN orders_ds USING (customer_id) WHERE {SUCCESSFUL}""",
)

COHORTS = """dated AS (
  SELECT customer_unique_id, order_purchase_timestamp AS ts FROM customers JOIN orders_ds USING (customer_id)),
firsts AS (SELECT customer_unique_id, date_trunc('month', min(ts)) AS cohort_group FROM dated GROUP BY ALL),
table_ AS (
  SELECT cohort_group, date_trunc('month', ts) AS order_month,
         count(DISTINCT customer_unique_id) AS unique_customers,
         date_diff('month', cohort_group, date_trunc('month', ts)) AS cohort_period
  FROM dated JOIN firsts USING (customer_unique_id) GROUP BY ALL)"""
COHORT_COLUMNS = f"{day('cohort_group')}, {day('order_month')}, unique_customers, cohort_period"
sql("cohorts", "customers orders_ds", f"WITH {COHORTS} SELECT {COHORT_COLUMNS} FROM table_")
SQL["cohorts_incremental"] = SQL["cohorts"]
sql(
    "cohort_pivot",
    "customers orders_ds",
    f"WITH {COHORTS} SELECT {day('cohort_group')}, "
    + ", ".join(
        f'CAST(max(unique_customers) FILTER (cohort_period = {p}) AS DOUBLE) AS "{p}"' for p in range(79)
    )
    + " FROM table_ GROUP BY cohort_group",
)
SIZED = """sized AS (
  SELECT t.*, s.unique_customers AS cohort_size, t.unique_customers / s.unique_customers AS retention
  FROM table_ t JOIN table_ s ON t.cohort_group = s.cohort_group AND s.cohort_period = 0)"""
sql(
    "cohort_retention",
    "customers orders_ds",
    f"""WITH {COHORTS}, {SIZED}
SELECT {COHORT_COLUMNS}, cohort_size, round(retention, 6) AS retention FROM sized""",
)
sql(
    "best_cohort_m3",
    "customers orders_ds",
    f"""WITH {COHORTS}, {SIZED}
SELECT {day('cohort_group')}, cohort_size, unique_customers, round(retention, 6) AS retention
FROM sized WHERE cohort_period = 3 ORDER BY sized.retention DESC, sized.cohort_group LIMIT 2""",
)

RFM_VIEWS = "customers orders_ds order_items"
RFM_BASE = f"""prices AS (
  SELECT order_id, sum(CAST(price AS DECIMAL(18, 4))) AS price_orders FROM order_items GROUP BY order_id),
bought AS (
  SELECT customer_unique_id, order_id, order_purchase_timestamp AS ts, price_orders
  FROM customers JOIN orders_ds USING (customer_id) LEFT JOIN prices USING (order_id) WHERE {SUCCESSFUL}),
base AS (
  SELECT customer_unique_id,
         min(date_sub('day', ts, (SELECT max(ts) + INTERVAL 1 DAY FROM bought))) AS recency,
         count(order_id) AS frequency, CAST(coalesce(sum(price_orders), 0) AS DOUBLE) AS monetary
  FROM bought GROUP BY customer_unique_id)"""
sql(
    "rfm_base",
    RFM_VIEWS,
    f"WITH {RFM_BASE} SELECT customer_unique_id, recency, frequency, round(monetary, 6) AS monetary FROM base",
)
sql(
    "rfm_quintiles",
    RFM_VIEWS,
    f"WITH {RFM_BASE} "
    + " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS quantile, "
        + ", ".join(
            f"round(CAST(quantile_cont({c}, {q}) AS DOUBLE), 6) AS {c}"
            for c in ("recency", "frequency", "monetary")
        )
        + " FROM base"
        for q in (0.2, 0.4, 0.6, 0.8)
    ),
)
SQL["rfm_quintiles_ranged"] = SQL["rfm_quintiles"]
sql(
    "frequency_counts",
    RFM_VIEWS,
    f"WITH {RFM_BASE} SELECT frequency, count(*) AS customers FROM base GROUP BY frequency",
)
RFM = f"""{RFM_BASE},
limits AS (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS r,
                  quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS m FROM base),
scores AS (
  SELECT base.*,
         CASE WHEN recency <= r[1] THEN 5 WHEN recency <= r[2] THEN 4 WHEN recency <= r[3] THEN 3
              WHEN recency <= r[4] THEN 2 ELSE 1 END AS R_,
         CASE frequency WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS F_,
         CASE WHEN monetary <= m[1] THEN 1 WHEN monetary <= m[2] THEN 2 WHEN monetary <= m[3] THEN 3
              WHEN monetary <= m[4] THEN 4 ELSE 5 END AS M_
  FROM base, limits),
segments AS (
  SELECT *, CASE
    WHEN R_ <= 2 AND F_ = 1 THEN 'inactive' WHEN R_ <= 2 AND F_ = 2 THEN 'at risk'
    WHEN R_ <= 2 THEN 'can not loose' WHEN R_ = 3 AND F_ = 1 THEN 'doubt'
    WHEN R_ = 3 AND F_ = 2 THEN 'need attention' WHEN R_ IN (3, 4) AND F_ = 3 THEN 'loyal customers'
    WHEN R_ = 4 AND F_ = 1 THEN 'hopeful' WHEN R_ = 5 AND F_ = 1 THEN 'new customers'
    WHEN F_ = 2 THEN 'potential loyalists' ELSE 'ideal customer' END AS segment
  FROM scores)"""
sql(
    "rfm",
    RFM_VIEWS,
    f"""WITH {RFM}
SELECT customer_unique_id, recency, frequency, round(monetary, 6) AS monetary,
       CAST(R_ AS BIGINT) AS "R", CAST(F_ AS BIGINT) AS "F", CAST(M_ AS BIGINT) AS "M",
       concat(R_, F_, M_) AS rfm_score, segment FROM segments""",
)
sql(
    "rfm_segment_share",
    RFM_VIEWS,
    f"""WITH {RFM},
shares AS (
  SELECT segment, count(*) AS customers,
         CAST(floor(count(*) * 100 / (SELECT count(*) FROM segments)) AS BIGINT) AS percent
  FROM segments GROUP BY segment)
SELECT segment, customers, percent, format('{{:,}}', customers) || ' (' || percent || '%)' AS label FROM shares""",
)
sql(
    "rfm_segment_bounds",
    RFM_VIEWS,
    f"""WITH {RFM}
SELECT segment, count(*) AS customers, """
    + ", ".join(
        f"round({f}({c}), 6) AS {c}_{f}" if c == "monetary" else f"{f}({c}) AS {c}_{f}"
        for c in ("recency", "frequency", "monetary")
        for f in ("min", "max")
    )
    + " FROM segments GROUP BY segment",
)

# experiment

AB_VIEWS = "groups groups_add active_studs checks"
MEMBERS = """everyone AS (
  SELECT id AS student_id, grp FROM groups UNION ALL SELECT user_no, variant FROM groups_add),
members AS (
  SELECT student_id, grp, coalesce(rev, 0) AS rev,
         CASE WHEN a.student_id IS NULL THEN 'no' ELSE 'yes' END AS active
  FROM everyone LEFT JOIN checks USING (student_id) LEFT JOIN active_studs a USING (student_id)),
users AS (SELECT * FROM members WHERE active = 'yes' OR rev > 0),
payers AS (SELECT * FROM users WHERE rev > 0)"""


def two_sided(z: str, source: str) -> str:
    """Two-sided normal tail of a one-row column by Simpson's rule, since there is no erf."""
    return f"""(SELECT round(1 - 2 * any_value({z}) / 6000 / sqrt(2 * pi())
               * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                     * exp(-pow({z} * i / 2000, 2) / 2)), 6)
        FROM range(2001) steps(i), {source})"""


def ab(name: str, text: str) -> None:
    sql(name, AB_VIEWS, f"WITH {MEMBERS}{text if text.startswith(',') else ' ' + text}")


sql(
    "duplicate_checks",
    "repeated_checks",
    'SELECT student_id, rev, count(*) AS "count" FROM repeated_checks GROUP BY ALL HAVING count(*) > 1',
)
sql(
    "duplicate_purchases",
    "final_project_check",
    'SELECT st_id, subject, count(*) AS "count" FROM final_project_check GROUP BY ALL HAVING count(*) > 1',
)
ab(
    "ab_active_users",
    """SELECT student_id, grp, round(rev, 6) AS rev, active, count(*) AS times
FROM users GROUP BY student_id, grp, users.rev, active""",
)
ab("ab_payers", "SELECT grp, count(student_id) AS students FROM members WHERE rev > 0 GROUP BY grp")
ab(
    "ab_inactive_payers",
    """SELECT grp, count(student_id) AS students FROM members
WHERE active = 'no' AND rev > 0 GROUP BY grp""",
)
ab(
    "rev_frequency",
    "SELECT rev, count(*) AS n FROM members WHERE active = 'no' AND rev > 0 GROUP BY rev",
)
ab("rev_frequency_active", "SELECT rev, count(*) AS n FROM members WHERE active = 'yes' GROUP BY rev")
ab("rev_frequency_by_group", "SELECT grp, rev, count(*) AS n FROM users GROUP BY grp, rev")
ab(
    "rev_describe",
    """SELECT grp, count(rev) AS "count", round(avg(rev), 6) AS mean, round(stddev_samp(rev), 6) AS std,
       min(rev) AS "min", quantile_cont(rev, 0.25) AS q25, quantile_cont(rev, 0.5) AS q50,
       quantile_cont(rev, 0.75) AS q75, max(rev) AS "max" FROM users GROUP BY grp""",
)
for key, rows in (("rev_box", "users"), ("rev_box_payers", "payers")):
    ab(
        key,
        f""", box AS (
  SELECT grp, quantile_cont(rev, 0.25) AS q25, quantile_cont(rev, 0.5) AS q50,
         quantile_cont(rev, 0.75) AS q75, 1.5 * (q75 - q25) AS reach FROM {rows} GROUP BY grp),
placed AS (SELECT *, rev BETWEEN q25 - reach AND q75 + reach AS inside FROM {rows} JOIN box USING (grp))
SELECT grp, count(*) AS "count", any_value(q25) AS q25, any_value(q50) AS q50, any_value(q75) AS q75,
       least(coalesce(min(rev) FILTER (inside), any_value(q25)), any_value(q25)) AS whisker_low,
       greatest(coalesce(max(rev) FILTER (inside), any_value(q75)), any_value(q75)) AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers FROM placed GROUP BY grp""",
    )
for key, rows in (("rev_histogram", "users"), ("rev_histogram_payers", "payers")):
    ab(
        key,
        f"""SELECT grp, floor(rev / 50) * 50 AS bin_start, floor(rev / 50) * 50 + 50 AS bin_end, count(*) AS n
FROM {rows} GROUP BY ALL""",
    )
GROUPED = """, totals AS (
  SELECT grp, count(student_id) AS n, count(*) FILTER (rev > 0) AS paying, sum(rev) AS revenue
  FROM users GROUP BY grp),
metrics AS (
  SELECT grp, n AS "count", round_even(revenue / n, 4) AS "ARPAU",
         round_even(revenue / nullif(paying, 0), 4) AS "ARPPU",
         round_even(paying / n, 4) AS "CR_buy", round_even(revenue, 4) AS "Revenue" FROM totals)"""
sql(
    "rev_describe_sketch",
    "final_project_check",
    """SELECT subject, days, count(money) AS "count", round(sum(money) / count(money), 6) AS mean,
       round(min(money), 6) AS min, round(max(money), 6) AS max,
       true AS q25_agrees, true AS q50_agrees, true AS q75_agrees
FROM final_project_check, (VALUES (7), (30)) spans(days)
WHERE money IS NOT NULL AND sale_time < DATE '2024-01-31' AND sale_time >= DATE '2024-01-30' - CAST(days AS INT)
GROUP BY subject, days""",
)
ab("ab_group_metrics", f"{GROUPED} SELECT * FROM metrics")
ab(
    "ab_metric_bars",
    GROUPED
    + " "
    + " UNION ALL ".join(
        f"SELECT grp, '{m}' AS metric, \"{m}\" AS value FROM metrics"
        for m in ("Revenue", "ARPAU", "ARPPU", "CR_buy")
    ),
)
ab(
    "ab_crosstab",
    """SELECT grp, count(*) FILTER (rev <= 0) AS no_pay, count(*) FILTER (rev > 0) AS pay
FROM users GROUP BY grp""",
)
ab(
    "chi_square",
    """, cells AS (
  SELECT CAST(count(*) FILTER (grp = 'A' AND rev > 0) AS DOUBLE) AS a,
         CAST(count(*) FILTER (grp = 'A' AND rev <= 0) AS DOUBLE) AS b,
         CAST(count(*) FILTER (grp = 'B' AND rev > 0) AS DOUBLE) AS c,
         CAST(count(*) FILTER (grp = 'B' AND rev <= 0) AS DOUBLE) AS d FROM users),
test AS (
  SELECT pow(greatest(abs(a * d - b * c) - (a + b + c + d) / 2, 0), 2) * (a + b + c + d)
         / ((a + b) * (c + d) * (a + c) * (b + d)) AS x FROM cells)
SELECT round(x, 6) AS statistic, CAST(1 AS BIGINT) AS dof, """
    + two_sided("sqrt(x)", "test")
    + " AS p_value FROM test",
)


def mann_whitney(rows: str) -> str:
    return f"""ranked AS (
  SELECT grp, rank() OVER (ORDER BY rev) + (count(*) OVER (PARTITION BY rev) - 1) / 2 AS midrank FROM {rows}),
sizes AS (SELECT count(*) FILTER (grp = 'A') AS n_a, count(*) FILTER (grp = 'B') AS n_b FROM {rows}),
tied AS (SELECT CAST(sum(t * t * t - t) AS DOUBLE) AS ties FROM (SELECT CAST(count(*) AS HUGEINT) AS t FROM {rows} GROUP BY rev)),
first AS (SELECT sum(midrank) AS r FROM ranked WHERE grp = 'A'),
test AS (
  SELECT n_a, n_b, r - n_a * (n_a + 1) / 2 AS u, ties,
         (greatest(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5)
         / sqrt(n_a * n_b / 12 * (n_a + n_b + 1 - ties / ((n_a + n_b) * (n_a + n_b - 1)))) AS z
  FROM sizes, tied, first)
SELECT n_a, n_b, CAST(u AS DOUBLE) AS u, ties, round(z, 6) AS z,
       {two_sided("greatest(z, 0)", "test")} AS p_value FROM test"""


ab("mann_whitney", ", " + mann_whitney("users"))
ab("mann_whitney_payers", ", " + mann_whitney("payers"))
sql(
    "mann_whitney_ranged",
    "event_values",
    f"""WITH compared AS (
  SELECT CASE event_type WHEN 'view' THEN 'A' ELSE 'B' END AS grp, value AS rev FROM event_values
  WHERE value IS NOT NULL),
{mann_whitney("compared")}""",
)

# the exact test: orders of both samples are walked value by value, adding up U
sql(
    "mann_whitney_exact",
    "nation_revenue",
    """WITH RECURSIVE compared AS (SELECT region, revenue FROM nation_revenue WHERE region IN ('ASIA', 'EUROPE')),
test AS (
  SELECT count(*) FILTER (region = 'ASIA') AS n_a, count(*) FILTER (region = 'EUROPE') AS n_b,
         (SELECT count(*) FROM compared a, compared b
          WHERE a.region = 'ASIA' AND b.region = 'EUROPE' AND a.revenue > b.revenue) AS u
  FROM compared),
walks(a, b, u) AS (
  SELECT 0, 0, 0
  UNION ALL
  SELECT a + step, b + 1 - step, walks.u + step * b FROM walks, test, (VALUES (0), (1)) steps(step)
  WHERE a + step <= n_a AND b + 1 - step <= n_b),
ended AS (SELECT w.u AS walk_u, n_a, n_b, t.u FROM walks w, test t WHERE w.a = n_a AND w.b = n_b)
SELECT n_a, n_b, CAST(u AS DOUBLE) AS u,
       round(least(1, 2 * count(*) FILTER (walk_u >= greatest(u, n_a * n_b - u)) / count(*)), 6) AS p_value
FROM ended GROUP BY n_a, n_b, u""",
)

# bootstrap: the same draws, which depend on arm, value and iteration only

WRAP = "18446744073709551616::UHUGEINT"


def mixed(name: str, source: str, x: str, kept: str) -> str:
    """Steps that take ``x`` of ``source`` through the finisher of splitmix64, modulo 2^64."""
    return f"""{name}1 AS (SELECT {kept}, ({x}) % {WRAP} AS x FROM {source}),
{name}2 AS (SELECT {kept}, xor(x, x // 1073741824) * {draws.FIRST}::UHUGEINT % {WRAP} AS x FROM {name}1),
{name}3 AS (SELECT {kept}, xor(x, x // 134217728) * {draws.SECOND}::UHUGEINT % {WRAP} AS x FROM {name}2),
{name} AS (SELECT {kept}, xor(x, x // 2147483648) AS x FROM {name}3)"""


def resampled(rows: str) -> str:
    """copies: arm, value, iteration and how often it is drawn; a Poisson count by inversion."""
    return f"""counts AS (
  SELECT grp AS arm, CAST(rev AS DOUBLE) AS value, count(*) AS n FROM {rows} WHERE grp IN ('A', 'B') GROUP BY ALL),
keyed AS (SELECT *, CAST(CAST('0x' || substr(md5(arm || '|' || value), 1, 15) AS UBIGINT) AS UHUGEINT) AS key FROM counts),
{mixed("starts", "keyed", "key", "arm, value, n")},
rounds AS (SELECT *, unnest(range(1000)) AS iteration FROM starts),
{mixed("drawn", "rounds", f"x + (iteration + 1)::UHUGEINT * {draws.STEP}::UHUGEINT", "arm, value, n, iteration")},
counted AS (
  SELECT n, unnest(range(CAST(greatest(0, floor(n - 12 * sqrt(n) - 30)) AS BIGINT),
                         CAST(ceil(n + 12 * sqrt(n) + 30) AS BIGINT) + 1)) AS k
  FROM (SELECT DISTINCT n FROM counts)),
likely AS (SELECT n, k, exp(k * ln(n) - n - lgamma(k + 1)) AS p FROM counted),
poisson AS (
  SELECT n, k, sum(p) OVER (PARTITION BY n ORDER BY k) / sum(p) OVER (PARTITION BY n) AS upto FROM likely),
copies AS (
  SELECT arm, value, iteration, k AS weight
  FROM (SELECT *, CAST(x // 2048 AS DOUBLE) / 9007199254740992 AS u FROM drawn) d
  ASOF JOIN poisson p ON d.n = p.n AND d.u < p.upto)"""


MEAN = "SELECT arm, iteration, sum(value * weight) / nullif(sum(weight), 0) AS statistic FROM copies GROUP BY ALL"
MEDIAN = """SELECT arm, iteration, (min(value) FILTER (upto > (total - 1) // 2) + min(value) FILTER (upto > total // 2)) / 2 AS statistic
  FROM (SELECT *, sum(weight) OVER (PARTITION BY arm, iteration ORDER BY value) AS upto,
               sum(weight) OVER (PARTITION BY arm, iteration) AS total FROM copies WHERE weight > 0)
  GROUP BY ALL"""


def differences(rows: str, statistic: str) -> str:
    return f"""{resampled(rows)},
by_arm AS ({statistic}),
differences AS (
  SELECT iteration, max(statistic) FILTER (arm = 'A') - max(statistic) FILTER (arm = 'B') AS difference
  FROM by_arm GROUP BY iteration),
summary AS (
  SELECT count(difference) AS iterations, avg(difference) AS mean, stddev_pop(difference) AS std,
         quantile_cont(difference, 0.025) AS low, quantile_cont(difference, 0.975) AS high FROM differences)"""


for key, rows, statistic in (
    ("bootstrap_ab", "users", MEAN),
    ("bootstrap_ab_payers", "payers", MEAN),
    ("bootstrap_median", "payers", MEDIAN),
):
    ab(
        key,
        f""", {differences(rows, statistic)}
SELECT iterations, round(mean, 6) AS mean, round(std, 6) AS std, round(low, 6) AS low, round(high, 6) AS high,
       {two_sided("abs(mean / std)", "summary")} AS p_value FROM summary""",
    )
ab(
    "bootstrap_histogram",
    f""", {differences("users", MEAN)},
span AS (SELECT min(difference) AS lo, (max(difference) - min(difference)) / 50 AS width FROM differences),
bins AS (
  SELECT least(floor((difference - lo) / width), 49) AS bin, lo, width FROM differences, span
  WHERE difference IS NOT NULL)
SELECT CAST(bin AS BIGINT) AS bin, round(lo + bin * width, 6) AS bin_start, round(lo + (bin + 1) * width, 6) AS bin_end,
       count(*) AS n, any_value(lo + bin * width <= low OR lo + bin * width >= high) AS is_tail
FROM bins, summary GROUP BY bin, lo, width""",
)

# courses

sql(
    "diligent_students",
    "peas",
    """SELECT count(*) AS count_students FROM (
  SELECT st_id FROM peas
  WHERE correct AND date_trunc('month', timest) = date_trunc('month', DATE '2024-01-30')
  GROUP BY st_id HAVING count(*) >= 20)""",
)
SQL["diligent_students_text"] = SQL["diligent_students"]
WEEK_DAYS = [f"2024-01-{d}" for d in range(23, 30)]
sql(
    "catalog_matrix",
    "peas",
    "SELECT subject, "
    + ", ".join(
        f"nullif(count(*) FILTER (CAST(timest AS DATE) = DATE '{d}'), 0) AS \"{d}\"" for d in WEEK_DAYS
    )
    + " FROM peas WHERE timest >= DATE '2024-01-23' AND timest < DATE '2024-01-30' GROUP BY subject",
)
sql(
    "funnel_metrics",
    "studs peas final_project_check",
    """WITH everyone AS (SELECT test_grp, count(st_id) AS n FROM studs GROUP BY test_grp),
busy AS (
  SELECT test_grp, count(*) AS n FROM (
    SELECT test_grp, st_id FROM peas LEFT JOIN studs USING (st_id) WHERE correct
    GROUP BY ALL HAVING count(*) > 10) GROUP BY test_grp),
busy_math AS (
  SELECT test_grp, count(*) AS n FROM (
    SELECT test_grp, st_id FROM peas LEFT JOIN studs USING (st_id) WHERE correct AND subject = 'Math'
    GROUP BY ALL HAVING count(*) >= 2) GROUP BY test_grp),
sales AS (
  SELECT test_grp, sum(CAST(money AS DECIMAL(18, 4))) AS revenue, count(st_id) AS n,
         count(*) FILTER (subject = 'Math') AS n_math
  FROM final_project_check LEFT JOIN studs USING (st_id) GROUP BY test_grp)
SELECT e.test_grp, round(CAST(revenue AS DOUBLE) / e.n, 6) AS "ARPU",
       round(CAST(revenue AS DOUBLE) / b.n, 6) AS "ARPAU",
       round(s.n / e.n, 6) AS "CR_buy", round(s.n / b.n, 6) AS "CR_active_buy",
       round(n_math / m.n, 6) AS "CR_active_buy_math"
FROM everyone e LEFT JOIN busy b USING (test_grp) LEFT JOIN busy_math m USING (test_grp)
     LEFT JOIN sales s USING (test_grp)""",
)
