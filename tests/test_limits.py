"""Amounts, tables, windows and files beyond the usual."""

import datetime as dt
import math

import pytest

from tidemark.functions import exprs
from tidemark.functions.tails import chi_square_tail
from tidemark.operators.retention import app_retention
from tidemark.sources.files import read_csv


def test_small_amounts_add_up(spark):
    df = spark.range(1000).selectExpr("0.00004D AS m")
    assert df.select(exprs.money_sum("m")).first()[0] == pytest.approx(0.04, abs=1e-15)


@pytest.mark.parametrize("k", [1, 2, 3, 10, 41, 1400, 1521, 3481])
def test_chi_square_tail_of_large_tables(spark, k):
    got = spark.createDataFrame([(x, k) for x in (0.0, float(k), 2.0 * k)], "x double, k int")
    values = [r[0] for r in got.select(chi_square_tail("x", "k")).collect()]
    assert values[0] == 1.0 and 0.3 < values[1] < 0.51 and 0 <= values[2] < 0.16
    if k % 2 == 0:  # a closed form: the chance of fewer than k / 2 events of a Poisson process
        half = k / 2
        want = math.fsum(math.exp(j * math.log(half) - half - math.lgamma(j + 1)) for j in range(k // 2))
        assert values[1] == pytest.approx(want, rel=1e-9)


def test_retention_of_any_number_of_days(spark):
    as_of = dt.date(2024, 6, 30)
    day = lambda back: dt.datetime.combine(as_of - dt.timedelta(days=back), dt.time(12))
    feed = spark.createDataFrame(
        [(1, day(89)), (1, day(89)), (1, day(28)), (1, day(27)), (2, day(100)), (2, day(5)), (3, day(0))],
        "user_id long, time timestamp",
    )
    got = app_retention(feed, feed.limit(0), as_of, 90).collect()
    back = lambda d: (as_of - d).days
    assert {(back(r["start_day"]), back(r["day"])): r["users"] for r in got} == {
        (89, 89): 1,
        (89, 28): 1,
        (89, 27): 1,
        (0, 0): 1,
    }


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("student_id,rev\n1,2.5\n")
    (tmp_path / "b.csv").write_text("rev,student_id\n3.5,4\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), "student_id bigint, rev double").collect()
