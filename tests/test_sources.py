"""Readers, writers and the staged tables."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import session
from tidemark.operators import campaigns, cohorts
from tidemark.sources import files, fixtures, profile, sinks, tables

SF_DIR = "/root/testdata/sf0.001"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_semicolon_and_quotes(spark, tmp_path):
    path = write(tmp_path / "checks.csv", '"student_id";"rev"\n1627;990.0\n3185;1900.0001\n7;\n')
    df = files.read_csv(spark, path, files.CHECKS_SCHEMA, sep=";")
    assert rows(df, "student_id") == [(7, None), (1627, 990.0), (3185, 1900.0001)]
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double"]


def test_decimal_comma(spark, tmp_path):
    names = [part.split()[0] for part in files.CAMPAIGNS_SCHEMA.split(", ")]
    line = '1,north,b_1,1000,10,5,2,"3208,440002","1,5","0,25",1,"2,5","0,5",2,"3,5","1,25",3'
    path = write(tmp_path / "ads.csv", ",".join(names) + "\n" + line + "\n")
    df = files.read_decimal_comma(spark, path, files.CAMPAIGNS_SCHEMA)
    got = df.first()
    assert (got.Spend, got.Revenue_ad30d, got.Revenue_in_app30d, got.Payers30d) == (3208.440002, 3.5, 1.25, 3)
    assert campaigns.campaign_metrics(df).first().CTR == 0.01


def test_only_wanted_text_columns_are_parsed(spark, tmp_path):
    path = write(tmp_path / "wide.csv", "a,b,c\n1,x,2\n")
    df = files.read_csv(spark, path, "c bigint")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == [(2,)] and "ReadSchema: struct<c:string>" in plan


def test_headers_are_aligned_by_position(spark):
    a = spark.createDataFrame([(1, "A")], "id long, grp string")
    b = spark.createDataFrame([(2, "B")], "user_no long, variant string")
    assert rows(a.unionByName(files.align_headers(b, a)), "id") == [(1, "A"), (2, "B")]


def test_times(spark):
    df = spark.createDataFrame([("2018-01-02 03:04:05", "x")], "t string, u string")
    got = files.parse_times(df, ["t", "u"]).first()
    assert str(got.t) == "2018-01-02 03:04:05" and got.u is None


def test_table_range_and_columns(spark):
    import datetime as dt

    path = f"{SF_DIR}/events.parquet"
    df = tables.read_table(spark, path, ["user_id"], "ts", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert df.columns == ["user_id"]
    assert df.count() == spark.read.parquet(path).where(F.dayofmonth("ts") == 2).count()
    spark.read.parquet(path).createOrReplaceTempView("some_events")
    assert tables.read_table(spark, "some_events").count() == 1000


def test_table_partitioned_by_day(spark, tmp_path):
    import datetime as dt

    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("d", F.to_date("ts"))
    events.coalesce(1).write.partitionBy("d").parquet(str(tmp_path / "events"))
    start, end = dt.date(2024, 1, 2), dt.datetime(2024, 1, 3, 12)
    df = tables.read_table(spark, str(tmp_path / "events"), ["user_id"], "ts", start, end, day="d")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "GreaterThanOrEqual(ts" in plan
    wanted = events.where("ts >= '2024-01-02' and ts < '2024-01-03 12:00:00'")
    assert df.count() == wanted.count() > 0


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.null_profile(df)) == [("a", "int", 2, 0), ("b", "string", 1, 1)]
    assert profile.preview(df, 1).count() == 1


def test_csv_export(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "out"))
    assert rows(spark.read.csv(str(tmp_path / "out"), header=True)) == [("1", "x")]


def test_daily_table(spark):
    import datetime as dt

    days = [dt.date(2024, 1, d) for d in (1, 2)]
    make = lambda *made: spark.createDataFrame(list(made), "event_date date, dimension string, views double")
    spark.sql("DROP TABLE IF EXISTS daily_slices_test")
    try:
        sinks.write_daily_table(make((days[0], "os", 1.0)), "daily_slices_test")
        sinks.write_daily_table(make((days[1], "os", 2.0)), "daily_slices_test")
        sinks.write_daily_table(make((days[1], "os", 3.0), (days[1], "age", 4.0)), "daily_slices_test")
        got = spark.table("daily_slices_test").select("event_date", "dimension", "views")
        assert rows(got, "event_date", "dimension") == [
            (days[0], "os", 1.0),
            (days[1], "age", 4.0),
            (days[1], "os", 3.0),
        ]
    finally:
        spark.sql("DROP TABLE IF EXISTS daily_slices_test")


def test_jdbc_read_is_split():
    class Reader:
        def __init__(self):
            self.kind, self.given = None, {}

        def format(self, kind):
            self.kind = kind
            return self

        def options(self, **given):
            self.given.update(given)
            return self

        def load(self):
            return self

    got = tables.read_jdbc(
        SimpleNamespace(read=Reader()), "jdbc:x", "feed", "user_id", 0, 1000, 8, user="me"
    )
    assert got.kind == "jdbc"
    assert got.given == {
        "url": "jdbc:x",
        "dbtable": "feed",
        "partitionColumn": "user_id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "8",
        "user": "me",
    }


def test_stage_writes_to_the_shared_folder(spark):
    folder = session.shared_dir(spark)
    df = session.stage(spark.range(3), "numbers")
    assert rows(df, "id") == [(0,), (1,), (2,)]
    assert all(folder in f for f in df.inputFiles())
    session.clear_staged(spark)
    assert not os.path.exists(f"{folder}/tidemark/{spark.sparkContext.applicationId}")


class Bare:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = SimpleNamespace(get=lambda key, default: default)
        self.sparkContext = SimpleNamespace(
            master=master, applicationId="app-1", getCheckpointDir=lambda: None
        )


def test_shared_folder_must_be_named_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Bare("yarn"))


def test_local_sessions_get_one_temporary_folder():
    assert session.shared_dir(Bare("local[2]")) == session.shared_dir(Bare("local[2]"))


@pytest.mark.parametrize(
    "name, count",
    [
        ("feed_actions", 398),
            ("started_feed", 381),
            ("feed_burst", 425),
        ("message_actions", 602),
            ("started_messages", 565),
        ("peas", 1000),
        ("studs", 14),
        ("final_project_check", 202),
        ("customers", 1503),
        ("orders_ds", 1500),
        ("order_items", 6000),
        ("groups", 142),
        ("groups_add", 8),
        ("active_studs", 51),
        ("checks", 12),
            ("repeated_checks", 16),
        ("campaigns", 10),
    ],
)
def test_view_sizes(spark, name, count):
    assert fixtures.view(spark, SF_DIR, name).count() == count
