"""Tables kept in the catalog, in files or behind a JDBC connection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import time_range


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    time: str | None = None,
    start: dt.date | dt.datetime | None = None,
    end: dt.date | dt.datetime | None = None,
    day: str | None = None,
) -> DataFrame:
    """A catalog table, or the Parquet files at a path, limited to columns and a time range.

    ``day`` names the date column the table is partitioned by, if any; other days are not listed.
    """
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if day and start is not None:
        df = df.where(F.col(day) >= F.lit(_date(start)))
    if day and end is not None:
        df = df.where(F.col(day) <= F.lit(_date(end)))
    if time:
        df = time_range(df, time, start, end)
    return df.select(*columns) if columns else df


def _date(value: dt.date | dt.datetime) -> dt.date:
    return value.date() if isinstance(value, dt.datetime) else value


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    low: int | str,
    high: int | str,
    parts: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``parts`` tasks at once, each with its own range of ``split_on``.

    The limits only set the ranges; rows beyond them are read too, by the outer tasks.
    """
    split = {
        "partitionColumn": split_on,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **split, **options).load()


def write_clustered(df: DataFrame, path: str, key: str, row_group_bytes: int = 8 << 20, **options: str) -> None:
    """Write ``df`` for lookups of single keys: in order of ``key``, with a Bloom filter for each row group.

    A filter on ``key`` then skips files and row groups by their limits, and most of what is left by the
    Bloom filter. Ranges are cut by rows, so a key with very many rows fills row groups of its own.
    """
    (
        df.repartitionByRange(F.col(key))
        .sortWithinPartitions(key)
        .write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .options(**options)
        .parquet(path)
    )
