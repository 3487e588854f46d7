"""Delimited text with the quirks of the source files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKS_SCHEMA = "student_id bigint, rev double"
GROUPS_SCHEMA = "id bigint, grp string"
ACTIVE_SCHEMA = "student_id bigint"
CUSTOMERS_SCHEMA = "customer_id string, customer_unique_id string"
ORDERS_SCHEMA = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp"
)
ITEMS_SCHEMA = "order_id string, product_id string, price double, shipping_limit_date timestamp"

CAMPAIGNS_SCHEMA = (
    "Campaign_id bigint, Geo string, Buyer string, Impressions bigint, Clicks bigint, "
    "Installs bigint, Registrations bigint, Spend double, "
    "Revenue_ad1d double, Revenue_in_app1d double, Payers1d bigint, "
    "Revenue_ad7d double, Revenue_in_app7d double, Payers7d bigint, "
    "Revenue_ad30d double, Revenue_in_app30d double, Payers30d bigint"
)


def _text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text. Fails on a file whose header isn't that of the first one.

    Spark takes columns by their place in the first file; checked, a file in another order can't swap them.
    """
    names = spark.read.csv(path, header=True, sep=sep).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.csv(path, header=True, sep=sep, schema=schema, enforceSchema=False)


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ","
) -> DataFrame:
    """Text with a header row and a known schema, so the file is read once.

    Columns are matched by name; those the schema leaves out are not parsed. Files of one folder must
    have the same header; read others apart and unite them with ``unionByName``.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = _text(spark, path, sep)
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def read_decimal_comma(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ","
) -> DataFrame:
    """Like ``read_csv``, for files that write 3208,44 where Spark expects 3208.44."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = _text(spark, path, sep)
    columns = []
    for field in wanted:
        source = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            source = F.replace(source, F.lit(","), F.lit("."))
        columns.append(source.cast(field.dataType).alias(field.name))
    return text.select(*columns)


def align_headers(df: DataFrame, like: DataFrame) -> DataFrame:
    """Give ``df`` the column names of ``like``, by position."""
    return df.toDF(*like.columns)


def parse_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to timestamps; text that is not a time becomes null."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in columns})
