import pytest
from pyspark.sql import functions as F

from aerolens.operators import reports
from aerolens.operators.topk import top_k, top_k_per_group
from conftest import rows

COLS = (
    "Year int, ORIGIN string, DestinationState string, DestinationCity string, OriginCity string, "
    "OP_CARRIER string, DEP_TIME double, ARR_TIME double, DEP_DELAY double, ARR_DELAY double, "
    "TAXI_OUT double, DISTANCE double, Parts_of_day string, Seasons string, Day_Name string, "
    "Day_OfWeek int, Month int"
)


def flight(**kw):
    base = dict(
        Year=2000, ORIGIN="A", DestinationState="S", DestinationCity="c", OriginCity="o",
        OP_CARRIER="C1", DEP_TIME=1.0, ARR_TIME=1.0, DEP_DELAY=0.0, ARR_DELAY=0.0,
        TAXI_OUT=10.0, DISTANCE=100.0, Parts_of_day="Morning", Seasons="WINTER",
        Day_Name="Monday", Day_OfWeek=2, Month=1,
    )
    base.update(kw)
    return tuple(base[c.split()[0]] for c in COLS.split(", "))


def frame(spark, flights):
    return spark.createDataFrame(flights, COLS)


def test_top_k_cuts_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), (None, 5), ("d", 1)], "k string, n int")
    assert rows(top_k(df, 2, "n", ["k"])) == [(None, 5), ("a", 5)]


def test_top_k_per_group_keeps_ties(spark):
    df = spark.createDataFrame(
        [(1, "a", 9), (1, "b", 9), (1, "c", 7), (1, "d", 5), (2, "e", 1), (None, "f", 3)],
        "g int, k string, n int",
    )
    out = sorted(rows(top_k_per_group(df, ["g"], "n", 2, ["g", "k"])), key=str)
    assert out == sorted([(1, "a"), (1, "b"), (1, "c"), (2, "e"), (None, "f")], key=str)


def test_top_k_per_group_is_planned_with_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g"), F.col("id").alias("n"))
    plan = top_k_per_group(df, ["g"], "n", 3, ["g", "n"])._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_counts_flown_versus_scheduled(spark):
    df = frame(spark, [flight(), flight(DEP_TIME=None), flight(ORIGIN=None)])
    assert dict(rows(reports.top_destination_states(df))) == {"S": 2}
    assert sorted(rows(reports.top_origins(df)), key=str) == [("A", 2), (None, 0)]
    assert rows(reports.flights_per_month(df, year=2000)) == [(1, 3)]
    assert rows(reports.flights_per_month(df)) == [(2000, 1, 3)]


def test_year_parameter_filters(spark):
    df = frame(spark, [flight(Year=1999), flight(Year=2000), flight(Year=2000, OP_CARRIER="C2")])
    assert rows(reports.flights_per_carrier(df, year=2000)) == [("C1", 1), ("C2", 1)]
    assert rows(reports.flights_per_weekday(df, year=1999)) == [("Monday", 1)]
    assert rows(reports.flights_per_carrier(df)) == [(1999, "C1", 1), (2000, "C1", 1), (2000, "C2", 1)]


def test_two_state_comparison_needs_rows_in_both_states(spark):
    df = frame(spark, [
        flight(Year=1998, DestinationState="X"),
        flight(Year=1998, DestinationState="Y"), flight(Year=1998, DestinationState="Y"),
        flight(Year=1999, DestinationState="X"),                  # Y missing: year dropped
        flight(Year=2000, DestinationState="X"),
        flight(Year=2000, DestinationState="Y", DEP_TIME=None),   # Y present, none flown
    ])
    assert rows(reports.two_state_comparison(df, "X", "Y")) == [(1998, 1, 2), (2000, 1, 0)]


def test_ranked_by_count_returns_average(spark):
    df = frame(spark, [
        flight(ORIGIN="A", DEP_DELAY=10.0), flight(ORIGIN="A", DEP_DELAY=20.0),
        flight(ORIGIN="B", DEP_DELAY=99.0),
    ])
    assert rows(reports.airport_departure_delay(df, k=1)) == [(2000, "A", 15.0)]
    assert rows(reports.airport_taxi_out(df, k=2)) == [(2000, "A", 10.0), (2000, "B", 10.0)]


def test_distance_ranked_by_sum(spark):
    df = frame(spark, [
        flight(OP_CARRIER="C1", DISTANCE=100.0), flight(OP_CARRIER="C1", DISTANCE=100.0),
        flight(OP_CARRIER="C2", DISTANCE=500.0),
    ])
    assert rows(reports.carrier_distance_per_year(df, k=1)) == [("C2", 2000, 500.0)]


def test_carrier_average_delays_top_by_flown(spark):
    df = frame(spark, [
        flight(OP_CARRIER="C1", DEP_DELAY=4.0, ARR_DELAY=2.0),
        flight(OP_CARRIER="C1", DEP_DELAY=None, DEP_TIME=None, ARR_DELAY=None),
        flight(OP_CARRIER="C2", DEP_DELAY=1.0, ARR_DELAY=1.0),
        flight(OP_CARRIER="C2", DEP_DELAY=3.0, ARR_DELAY=5.0),
    ])
    assert rows(reports.carrier_average_delays(df, k=1)) == [("C2", 2, 2.0, 3.0)]


def test_parts_of_day_share_sums_to_100(spark):
    df = frame(spark, [flight(Parts_of_day=p) for p in ["Morning"] * 3 + ["Afternoon", None]])
    out = rows(reports.parts_of_day_share(df))
    assert [(p, n) for p, n, _ in out] == [("Morning", 3), ("Afternoon", 1)]
    assert sum(s for _, _, s in out) == pytest.approx(100.0)
    assert out[0][2] == pytest.approx(75.0)


def test_city_pairs_rank_pairs_and_null_part_is_a_group(spark):
    df = frame(spark, [
        flight(OriginCity="o1", DestinationCity="d1"), flight(OriginCity="o1", DestinationCity="d1"),
        flight(OriginCity="o1", DestinationCity="d2"), flight(OriginCity="o2", DestinationCity="d2"),
        flight(Parts_of_day=None, OriginCity="o3", DestinationCity="d3", ARR_TIME=None),
    ])
    origin, dest = reports.top_cities_by_daypart(df, k=2)
    assert sorted(rows(origin), key=str) == sorted(
        [("Morning", "o1", 2), ("Morning", "o1", 1), ("Morning", "o2", 1), (None, "o3", 1)], key=str
    )
    assert sorted(rows(dest), key=str) == sorted(
        [("Morning", "d1", 2), ("Morning", "d2", 1), ("Morning", "d2", 1), (None, "d3", 0)], key=str
    )


def test_per_group_reports_shapes(spark):
    df = frame(spark, [flight(Year=y, DestinationState=s, OP_CARRIER=c, Seasons=z, Day_Name=d)
                       for y in (1999, 2000) for s in "STUVWXY" for c in ("C1", "C2")
                       for z in ("WINTER",) for d in ("Monday",)])
    assert reports.top_states_per_year(df).count() == 14  # 7 states tie at rank 1 each year
    assert reports.top_carriers_per_year(df).columns == ["Year", "OP_CARRIER", "Number"]
    assert reports.top_carriers_per_weekday(df).columns == ["Day_Name", "OP_CARRIER", "Day_OfWeek", "Number"]
    assert reports.top_states_per_season(df).columns == ["Seasons", "DestinationState", "NumberOfFlightsFlown"]
    assert rows(reports.top_cities_in_state_per_year(df, "S")) == [(1999, "c", 2), (2000, "c", 2)]


def test_positions_are_those_of_the_global_order(spark):
    from aerolens.operators.topk import with_position

    df = spark.range(5000).selectExpr("id", "CAST(pmod(id * 7919, 613) AS INT) AS k", "IF(id % 11 = 0, NULL, 'x') AS s").repartition(13)
    got = with_position(df, [F.col("k").desc(), F.col("s").asc_nulls_first(), "id"]).collect()
    want = sorted(got, key=lambda r: (-r["k"], r["s"] is not None, r["s"] or "", r["id"]))
    assert [r["position"] for r in want] == list(range(1, 5001))
    assert with_position(df.limit(0), ["id"]).collect() == []
    # Ties get places next to each other, one each.
    tied = with_position(df.select("k"), ["k"], "place").collect()
    assert sorted(r["place"] for r in tied) == list(range(1, 5001))
    assert [r["k"] for r in sorted(tied, key=lambda r: r["place"])] == sorted(r["k"] for r in tied)
