import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from punctual.functions import buckets, numbers, registry, text, times


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")


def values(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_hhmm(spark):
    df = column(spark, [0, 5, 930, 2359, 2400, None], "INT").withColumn("d", F.lit("2024-02-28").cast("date"))
    day = dt.datetime(2024, 2, 28)
    at = [day, day.replace(minute=5), day.replace(hour=9, minute=30), day.replace(hour=23, minute=59)]
    assert values(df, times.hhmm_text("x")) == ["0000", "0005", "0930", "2359", "2400", None]
    assert values(df, times.hhmm_timestamp("d", "x")) == [*at, None, None]
    assert values(df, times.hhmm_timestamp("d", "x", True)) == [*at, dt.datetime(2024, 2, 29), None]
    assert values(df, times.minutes_of_day("x")) == [0, 5, 570, 1439, 1440, None]
    assert values(df, times.hour_block("x"))[2] == "0900-0959"


def test_hhmm_from_doubles(spark):
    df = column(spark, [930.0, 7.0], "DOUBLE")
    assert values(df, times.hhmm_text("x")) == ["0930", "0007"]
    assert values(df, times.hhmm_hour("x")) == [9, 0]


def test_calendar(spark):
    df = column(spark, ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"], "STRING")
    df = df.withColumn("x", F.to_date("x"))
    assert values(df, times.iso_weekday("x")) == [5, 6, 7, 1]
    assert values(df, times.weekend_flag("x")) == [0, 1, 1, 0]
    assert values(df, times.weekday_name(times.iso_weekday("x"))) == ["Friday", "Saturday", "Sunday", "Monday"]
    numbers_ = column(spark, [0, 1, 3, 6, 9, 12, 13, None], "INT")
    assert values(numbers_, times.season("x")) == [None, "Winter", "Spring", "Summer", "Fall", "Winter", None, None]
    assert values(numbers_, times.weekday_name("x"))[-2:] == ["Unknown", "Unknown"]


def test_utc_does_not_depend_on_session_zone(spark):
    df = column(spark, ["America/New_York", "America/Denver", "UTC"], "STRING")
    local = F.lit("2024-07-01 12:00:00").cast("timestamp_ntz")
    expected = [dt.datetime(2024, 7, 1, hour) for hour in (16, 18, 12)]
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert values(df, times.local_to_utc(local, "x")) == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_buckets_and_null_rules(spark):
    df = column(spark, [None, 0, 4, 5, 14, 15, 24, 25], "INT")
    mph = values(df, buckets.bucketize("x", *buckets.WIND_MPH))
    assert mph == ["25+ mph", "<5 mph", "<5 mph", "5-15 mph", "5-15 mph", "15-25 mph", "15-25 mph", "25+ mph"]
    knots = values(df, buckets.bucketize("x", *buckets.WIND_KNOTS, null_label="Unknown"))
    assert knots == ["Unknown", "<5 kt", "<5 kt", "5-10 kt", "10-15 kt", "15+ kt", "15+ kt", "15+ kt"]


def test_list_labels(spark):
    df = column(spark, [None, [], ["a"], ["a", "b"]], "ARRAY<STRING>")
    assert values(df, text.list_label("x")) == ["None", "None", "a", "a,b"]
    assert values(df, text.list_label("x", ", ", null_label=None)) == [None, "None", "a", "a, b"]


def test_rates_survive_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a DOUBLE, b DOUBLE")
    shares = [row[0] for row in df.select(numbers.percent(F.col("a"), F.col("b"), 1)).collect()]
    assert sorted(shares, key=str) == [25.0, None]
    flags = column(spark, [True, False, None], "BOOLEAN")
    assert values(flags, numbers.flag(F.col("x"))) == [1, 0, 0]


def test_result_labels(spark):
    df = column(spark, [1.0, 0.0], "DOUBLE")
    assert values(df, text.delay_status("x")) == ["DELAYED", "On Time"]
    assert values(df, text.probability_text(F.col("x") / 3)) == ["0.333", "0.000"]


def test_registered_functions(spark):
    names = registry.register_sql_functions(spark)
    assert "list_label" in names
    row = spark.sql("SELECT list_label(array('x', 'y')), list_label(array()), hhmm_minutes(930), weekend_flag(DATE'2024-01-06')").first()
    assert tuple(row) == ("x,y", "None", 570, 1)

    def plus_one(values: pd.Series) -> pd.Series:
        return values + 1

    registry.register_vectorised(spark, "plus_one", plus_one, "bigint")
    assert spark.sql("SELECT plus_one(id) AS n FROM range(3)").agg(F.sum("n")).first()[0] == 6
