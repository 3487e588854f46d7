"""Result tables and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_SCHEMA = (
    "event_date date, dimension string, dimension_value string, views double, likes double, "
    "messages_received double, messages_sent double, users_received double, users_sent double"
)


def write_daily(df: DataFrame, path: str, day: str = "event_date") -> None:
    """Add the days in ``df`` to the table at ``path``; a day written again is replaced.

    A repeated run therefore leaves one copy of each day and does not touch the others.
    """
    (
        df.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_daily_table(df: DataFrame, table: str, day: str = "event_date") -> None:
    """Like ``write_daily`` for a catalog table, which is made if it does not exist.

    A table made elsewhere needs the property ``partitionOverwriteMode`` = ``dynamic``.
    """
    spark = df.sparkSession
    rows = df.hint("rebalance", F.col(day))
    if not spark.catalog.tableExists(table):
        # kept with the table, so no job has to change the session's mode
        mode = rows.write.option("partitionOverwriteMode", "dynamic")
        mode.partitionBy(day).format("parquet").saveAsTable(table)
        return
    rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep)
