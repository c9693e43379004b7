import pytest
from pyspark.sql import functions as F

from aerolens.operators.enrich import (
    LOCATION_COLUMNS,
    enrich,
    map_state_city,
    map_state_city_by_shuffle,
    unique_lookup,
)
from aerolens.sources.fixture import airports_from_customers, load_airports, load_flights
from conftest import SF_SMALL, rows


def _airports(spark):
    return spark.createDataFrame(
        [("Alpha Intl", "Alpha", "Texas", "AAA"), ("Beta", "Beta City", " Utah", "BBB"),
         ("Junk", None, None, None)],
        "Airport string, City string, State string, IATA string",
    )


def _flights(spark):
    return spark.createDataFrame(
        [(1, "AAA", "BBB"), (2, "ZZZ", "AAA"), (3, None, None), (4, "BBB", "BBB")],
        "id int, ORIGIN string, DEST string",
    )


def test_map_state_city_keeps_every_flight(spark):
    out = map_state_city(_flights(spark), _airports(spark))
    assert out.columns == ["id", "ORIGIN", "DEST"] + LOCATION_COLUMNS
    got = {r[0]: r[3:] for r in rows(out)}
    assert got == {
        1: ("Alpha", "Texas", "Beta City", " Utah"),
        2: (None, None, "Alpha", "Texas"),
        3: (None, None, None, None),
        4: ("Beta City", " Utah", "Beta City", " Utah"),
    }


def test_trim_state_is_opt_in(spark):
    out = map_state_city(_flights(spark), _airports(spark), trim_state=True)
    assert rows(out.filter("id = 4"), "OriginState") == [("Utah",)]


def test_shuffled_and_broadcast_lookup_give_the_same_rows(spark):
    from pyspark.sql import functions as F

    hinted = map_state_city(_flights(spark), F.broadcast(_airports(spark)))
    shuffled = map_state_city(_flights(spark), _airports(spark).hint("merge"))
    assert sorted(rows(hinted), key=str) == sorted(rows(shuffled), key=str)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()


def test_lookup_uses_every_customer(spark):
    """Codes A000-A119, whatever the number of customers; none is left out."""
    customer = spark.range(5000).selectExpr("id + 1 AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey")
    nation = spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name")
    got = {r["IATA"]: r["State"] for r in airports_from_customers(customer, nation).collect()}
    want = {}
    for key in range(1, 5001):
        want.setdefault(key % 120, []).append((key - 1) % 25)
    assert got == {f"A{k:03d}": f"N{sum(v) % 25}" for k, v in want.items()}


def test_enrich_on_fixture(spark):
    flights = load_flights(spark, SF_SMALL)
    out = enrich(flights, load_airports(spark, SF_SMALL))
    assert out.count() == flights.count()
    assert out.columns[:15] == flights.columns[:15]
    assert out.columns[15:] == LOCATION_COLUMNS + [
        "Year", "Month", "Day", "Day_Name", "Day_OfWeek", "Seasons", "Parts_of_day"
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2
    # The flights side is read once, pruned to the five source columns.
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_shipdate" in plan


def test_salted_lookup_gives_the_rows_of_the_plain_join(spark):
    flights = load_flights(spark, SF_SMALL).select("FL_DATE", "ORIGIN", "DEST", "DISTANCE")
    flights = flights.union(flights.limit(50).withColumn("ORIGIN", F.lit(None).cast("string")))
    airports = load_airports(spark, SF_SMALL)
    for share in (0.0, 0.01, 1.0):
        got = map_state_city_by_shuffle(flights, airports, share=share, salts=7)
        assert got.columns == flights.columns + LOCATION_COLUMNS
        assert sorted(rows(got), key=str) == sorted(rows(map_state_city(flights, airports)), key=str)
    empty = flights.limit(0)
    assert map_state_city_by_shuffle(empty, airports).collect() == []
    assert map_state_city_by_shuffle(flights, airports.limit(0)).count() == flights.count()


def test_salted_lookup_survives_a_hot_code_and_nulls(spark):
    """A third of the flights on one code and a third without: no task of the join
    has more than twice the median's rows, and the flights shuffle once a code."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(k, v)
    try:
        code = F.when(F.col("id") % 3 == 0, "AAA").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("C"), F.col("id") % 500))
        flights = spark.range(30_000).select("id", code.alias("ORIGIN"), code.alias("DEST"))
        codes = spark.range(500).select(F.concat(F.lit("C"), "id").alias("IATA"), F.lit("city").alias("City"), F.lit("state").alias("State"))
        airports = codes.union(spark.createDataFrame([("AAA", "hot", "texas")], "IATA string, City string, State string"))
        got = map_state_city_by_shuffle(flights, airports)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert got.count() == 30_000 and got.filter("OriginCity = 'hot' AND DestinationState = 'texas'").count() == 10_000
        assert got.filter("OriginCity IS NULL").count() == 10_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_repeated_codes_are_guarded(spark):
    same = _airports(spark).union(_airports(spark))
    assert unique_lookup(same).count() == 2
    other = _airports(spark).union(spark.createDataFrame([("X", "Elsewhere", "Ohio", "AAA")], _airports(spark).schema))
    with pytest.raises(Exception, match="several places: AAA"):
        map_state_city_by_shuffle(_flights(spark), other).collect()
