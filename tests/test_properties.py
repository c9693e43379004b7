"""Property tests: the column functions agree with plain-Python statements of
their rules on random inputs (one Spark job per example batch)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolens.functions import delay_label, part_of_day, season


def py_part(t):
    if t is None:
        return None
    if 0 <= t < 400:
        return "Early Morning"
    if 400 <= t < 1200:
        return "Morning"
    if 1200 <= t < 1800:
        return "Afternoon"
    if 1800 <= t <= 2359:
        return "Evening/Night"
    return None


def py_label(d):
    if d is not None and d < -10:
        return "Early"
    if d is not None and d > 10:
        return "Delay"
    return "OnTime"


def py_season(m):
    return {3: "SPRING", 4: "SPRING", 5: "SPRING", 6: "SUMMER", 7: "SUMMER", 8: "SUMMER",
            9: "AUTUMN", 10: "AUTUMN", 11: "AUTUMN", 12: "WINTER", 1: "WINTER", 2: "WINTER"}.get(m)


ints = st.one_of(st.none(), st.integers(min_value=-3000, max_value=3000))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(ints, st.one_of(st.none(), st.floats(-500, 500, allow_nan=False))), min_size=1, max_size=60))
def test_part_of_day_and_label_match_rules(spark, values):
    df = spark.createDataFrame(values, "t int, d double")
    got = df.select(part_of_day(F.col("t")).alias("p"), delay_label(F.col("d")).alias("l")).collect()
    assert [tuple(r) for r in got] == [(py_part(t), py_label(d)) for t, d in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-2, 15)), min_size=1, max_size=40))
def test_season_matches_rule(spark, months):
    df = spark.createDataFrame([(m,) for m in months], "m int")
    got = [r[0] for r in df.select(season(F.col("m"))).collect()]
    assert got == [py_season(m) for m in months]
