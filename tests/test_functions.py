import datetime as dt

from pyspark.sql import functions as F

from aerolens.functions import delay_label, part_of_day, season, with_calendar


def test_part_of_day_boundaries(spark):
    times = [0, 399, 400, 1199, 1200, 1799, 1800, 2359, 2400, -1, None]
    df = spark.createDataFrame([(t,) for t in times], "t int")
    got = dict(df.select("t", part_of_day(F.col("t")).alias("p")).collect())
    assert got == {
        0: "Early Morning", 399: "Early Morning",
        400: "Morning", 1199: "Morning",
        1200: "Afternoon", 1799: "Afternoon",
        1800: "Evening/Night", 2359: "Evening/Night",
        2400: None, -1: None, None: None,
    }


def test_delay_label_bounds_and_null(spark):
    df = spark.createDataFrame([(v,) for v in [-11.0, -10.0, 10.0, 11.0, None]], "d double")
    got = dict(df.select("d", delay_label(F.col("d")).alias("l")).collect())
    assert got == {-11.0: "Early", -10.0: "OnTime", 10.0: "OnTime", 11.0: "Delay", None: "OnTime"}


def test_seasons_cover_months_and_null_otherwise(spark):
    df = spark.createDataFrame([(m,) for m in list(range(0, 14)) + [None]], "m int")
    got = dict(df.select("m", season(F.col("m")).alias("s")).collect())
    assert [got[m] for m in (12, 1, 2)] == ["WINTER"] * 3
    assert [got[m] for m in (3, 4, 5)] == ["SPRING"] * 3
    assert [got[m] for m in (6, 7, 8)] == ["SUMMER"] * 3
    assert [got[m] for m in (9, 10, 11)] == ["AUTUMN"] * 3
    assert got[0] is None and got[13] is None and got[None] is None


def test_calendar_columns(spark):
    days = [dt.date(2018, 1, 7), dt.date(2017, 12, 30), None]
    df = with_calendar(spark.createDataFrame([(d,) for d in days], "FL_DATE date"))
    got = {r.FL_DATE: (r.Year, r.Month, r.Day, r.Day_Name, r.Day_OfWeek) for r in df.collect()}
    assert got[dt.date(2018, 1, 7)] == (2018, 1, 7, "Sunday", 1)
    assert got[dt.date(2017, 12, 30)] == (2017, 12, 30, "Saturday", 7)
    assert got[None] == (None, None, None, None, None)
