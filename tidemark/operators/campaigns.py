"""Advertising metrics per campaign and for groups of campaigns.

``campaigns``: Campaign_id, Geo, Buyer, Impressions, Clicks, Installs, Registrations, Spend,
Revenue_ad30d, Revenue_in_app30d.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio, zero_sum

# fixed values: names of columns and metrics
TOTALS = [
    "Impressions",
    "Clicks",
    "Installs",
    "Registrations",
    "Spend",
    "Revenue_ad30d",
    "Revenue_in_app30d",
]
METRICS = ["CTR", "CPI", "CR_regist", "CPO_30d", "ROI_30d"]


def with_metrics(totals: DataFrame) -> DataFrame:
    """Add 30-day revenue and the ratios to rows that hold the totals."""
    return totals.withColumn(
        "Revenue_30d", F.col("Revenue_ad30d") + F.col("Revenue_in_app30d")
    ).withColumns(
        {
            "CTR": ratio("Clicks", "Impressions"),
            "CPI": ratio("Spend", "Installs"),
            "CR_regist": ratio("Registrations", "Installs"),
            "CPO_30d": ratio("Spend", "Revenue_30d"),
            "ROI_30d": ratio(F.col("Revenue_30d") - F.col("Spend"), "Spend") * 100,
        }
    )


def campaign_metrics(campaigns: DataFrame) -> DataFrame:
    return with_metrics(campaigns).select("Campaign_id", "Geo", "Buyer", "Revenue_30d", *METRICS)


def group_metrics(campaigns: DataFrame, by: str) -> DataFrame:
    """Metrics per value of ``by``: totals first, ratios of the totals after."""
    totals = (
        campaigns.where(F.col(by).isNotNull())
        .groupBy(F.col(by).alias(by))
        .agg(*[zero_sum(name).alias(name) for name in TOTALS])
    )
    return with_metrics(totals).select(by, *TOTALS, "Revenue_30d", *METRICS)


def buyer_ranking(campaigns: DataFrame) -> DataFrame:
    """Metrics per buyer, best return first."""
    return group_metrics(campaigns, "Buyer").orderBy(F.desc_nulls_last("ROI_30d"), "Buyer")


def top_campaigns(
    metrics: DataFrame, metric: str, n: int = 5, ascending: bool = False
) -> DataFrame:
    """The ``n`` first campaigns by ``metric``; missing values come last, ties go by id."""
    order = F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)
    return (
        metrics.select("Campaign_id", "Geo", "Buyer", metric).orderBy(order, "Campaign_id").limit(n)
    )
