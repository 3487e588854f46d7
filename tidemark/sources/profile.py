"""A first look at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows with a value, rows without. One pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("all"),
        *[F.count(F.col(name)).alias(f"c{i}") for i, name in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null"),
            (F.col("all") - F.col(f"c{i}")).alias("nulls"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
