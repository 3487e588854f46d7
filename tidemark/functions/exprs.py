"""Column expressions shared by the operators. All stay inside Spark's generated code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den``; null where the denominator is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def round_even(c: Column | str, places: int) -> Column:
    """Half-even rounding of the scaled binary value, as NumPy rounds."""
    scale = float(10**places)
    return F.rint(col(c) * scale) / scale


def zero_sum(c: Column | str) -> Column:
    """Sum that is 0, not null, when there is nothing to add."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def money(c: Column | str) -> Column:
    """An amount with up to 18 decimals, below 10^20, as a decimal.

    Sums of it don't depend on the order in which partial sums arrive, so a repeated task gives the same value.
    Sums of sums stay decimals; only the last one is made a double, by ``as_double``.
    """
    return col(c).cast("decimal(38,18)")


def as_double(total: Column) -> Column:
    return F.coalesce(total.cast("double"), F.lit(0.0))


def money_sum(c: Column | str) -> Column:
    """Sum of an amount as a double, added up as decimals; 0 when there is nothing to add."""
    return as_double(F.sum(money(c)))


def not_in(c: Column | str, values: Iterable) -> Column:
    """NOT IN that keeps rows where the column is null."""
    return col(c).isNull() | ~col(c).isin(list(values))


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def months_between_starts(later: Column | str, earlier: Column | str) -> Column:
    """Whole months from one month start to another."""
    years = F.year(col(later)) - F.year(col(earlier))
    return years * 12 + F.month(col(later)) - F.month(col(earlier))


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed full 24-hour periods, rounded down."""
    return F.timestamp_diff("DAY", col(start), col(end))


def quarter_hour(c: Column | str) -> Column:
    return F.window(col(c), "15 minutes").getField("start")


def time_range(
    df: DataFrame,
    time: str,
    start: dt.date | dt.datetime | None,
    end: dt.date | dt.datetime | None,
) -> DataFrame:
    """Rows with ``start <= time < end``.

    The limits are cast to the column's own type, so the column is compared bare and the range
    reaches the file scan.
    """
    kind = df.schema[time].dataType
    if start is not None:
        df = df.where(F.col(time) >= F.lit(_moment(start)).cast(kind))
    if end is not None:
        df = df.where(F.col(time) < F.lit(_moment(end)).cast(kind))
    return df


def _moment(value: dt.date | dt.datetime) -> str:
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return value.isoformat(sep=" ")


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)
