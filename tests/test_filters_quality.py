import datetime as dt

import pytest

from aerolens.operators import filters, quality
from aerolens.operators.setops import combine
from conftest import rows


def test_not_cancelled_drops_one_and_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None)], "id int, CANCELLED double")
    assert rows(filters.not_cancelled(df), "id") == [(1,)]


def test_remove_outliers_threshold_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 399.0, 399.0), (2, 400.0, 0.0), (3, 0.0, 400.0), (4, None, 0.0), (5, -500.0, -500.0)],
        "id int, ARR_DELAY double, DEP_DELAY double",
    )
    assert sorted(rows(filters.remove_outliers(df), "id")) == [(1,), (5,)]


def test_for_year_by_date_and_by_year_column(spark):
    df = spark.createDataFrame(
        [(dt.date(1997, 12, 31), 1997), (dt.date(1998, 1, 1), 1998), (dt.date(1998, 12, 31), 1998),
         (dt.date(1999, 1, 1), 1999)],
        "FL_DATE date, Year int",
    )
    assert sorted(rows(filters.for_year(df, "1998"), "Year")) == [(1998,), (1998,)]
    assert rows(filters.for_year(df.drop("FL_DATE"), 1999)) == [(1999,)]
    with pytest.raises(ValueError):
        filters.for_year(df.drop("FL_DATE", "Year").withColumnRenamed("x", "y"), 1998)


def test_year_filter_reaches_the_scan(spark):
    from aerolens.sources.fixture import load_flights

    plan = filters.for_year(load_flights(spark, "/root/testdata/sf0.001"), 1998)._jdf
    text = plan.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "l_shipdate" in text.split("PushedFilters")[1]


def test_destination_state_is_a_literal(spark):
    df = spark.createDataFrame([("Texas",), ("' OR '1'='1",), (" Texas",)], "DestinationState string")
    assert rows(filters.for_destination_state(df, "Texas")) == [("Texas",)]
    assert rows(filters.for_destination_state(df, "' OR '1'='1")) == [("' OR '1'='1",)]


def test_part_of_day_filter(spark):
    df = spark.createDataFrame([("Morning",), (None,)], "Parts_of_day string")
    assert rows(filters.with_part_of_day_only(df)) == [("Morning",)]


def test_select_model_columns_keeps_year_on_request(spark):
    cols = filters.MODEL_COLUMNS + ["Year", "Other"]
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"`{c}` int" for c in cols))
    assert filters.select_model_columns(df).columns == filters.MODEL_COLUMNS
    assert filters.select_model_columns(df, keep_year=True).columns == filters.MODEL_COLUMNS + ["Year"]


def test_null_percentages(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, None)], "a int, b string")
    assert rows(quality.null_percentages(df)) == [(25.0, 75.0)]


def test_null_percentages_empty_frame_is_null_not_error(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(quality.null_percentages(df)) == [(None, None)]


def test_shape_and_drops(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert rows(quality.shape(df)) == [(1, 4)]
    assert quality.drop_trailing(df, 2).columns == ["a", "b"]
    assert quality.drop_trailing(df, 0).columns == ["a", "b", "c", "d"]
    assert quality.drop_columns(df, ["b", "missing"]).columns == ["a", "c", "d"]
    assert quality.preview(df, 5).count() == 1


def test_combine_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2), ("x", 1)], "v string, k int")
    out = combine(a, b, a)
    assert out.columns == ["k", "v"]
    assert sorted(rows(out)) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        combine()


def test_register_names_a_frame_for_sql(spark):
    from aerolens.sources import register

    a = register(spark.createDataFrame([(1,), (2,)], "k int"), "aerolens_test_view_a")
    b = register(spark.createDataFrame([(3,)], "k int"), "aerolens_test_view_b")
    assert a.count() == 2 and b.count() == 1
    got = spark.sql("SELECT sum(k) FROM aerolens_test_view_a").first()[0]
    assert got == 3  # the second registration did not overwrite the first
