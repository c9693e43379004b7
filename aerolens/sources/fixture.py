"""Flights-shaped and airports-shaped views derived from the driver's tables.

No flights file ships with the test data, so a flights view is derived from
``lineitem`` (one flight per line item) and an airport lookup from
``customer`` joined to ``nation``. Both are narrow projections: every flights
column is an arithmetic function of five ``lineitem`` columns, so the scan
reads only those five and nothing shuffles.

The formulas are fixed values shared with the DuckDB oracle
(``aerolens.plans.oracle``); both sides must compute identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.sources.files import read_parquet
from aerolens.sources.schemas import (
    CUSTOMER_SOURCE_SCHEMA,
    LINEITEM_SOURCE_SCHEMA,
    NATION_SOURCE_SCHEMA,
)


def _code(prefix: str, value: Column, width: int) -> Column:
    """``prefix`` and the number, padded to ``width``; longer numbers stay whole."""
    digits = value.cast("string")
    padded = F.when(F.length(digits) > width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def flights_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One flight row per line item, columns in the flights file order."""
    key = F.col("l_orderkey").cast("bigint")
    part = F.col("l_partkey").cast("bigint")
    base = lineitem.select(
        F.col("l_shipdate").cast("date").alias("FL_DATE"),
        (key * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey") * 7).alias("x"),
        (key * 13 + F.col("l_linenumber") * 5 + F.col("l_suppkey") * 3).alias("y"),
        (part * 11 + F.col("l_suppkey") * 19 + F.col("l_linenumber")).alias("z"),
    )
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    step = base.select(
        "FL_DATE", "x", "y", "z",
        (x % 53 == 0).alias("cxl"),
        (y % 89 == 0).alias("divd"),
        (x % 24).alias("hh"),
        (y % 60).alias("mm"),
        ((x % 61) - 20 + F.when(x % 101 == 0, 450).otherwise(0)).alias("dd"),
    )
    hh, mm, dd = F.col("hh"), F.col("mm"), F.col("dd")
    cxl, divd = F.col("cxl"), F.col("divd")
    t = (hh * 60 + mm + dd + 1440) % 1440
    lost = cxl | divd

    def unless(cond: Column, value: Column) -> Column:
        return F.when(cond, F.lit(None)).otherwise(value)

    def extra(v: Column) -> Column:
        return F.when(x % 9 == 0, (v % 40).cast("double"))

    return step.select(
        "FL_DATE",
        _code("C", F.least(x % 18, y % 18), 2).alias("OP_CARRIER"),
        _code("A", F.least(x % 125, z % 131), 3).alias("ORIGIN"),
        _code("A", F.least(y % 125, z % 137), 3).alias("DEST"),
        F.when(y % 97 == 0, 2400).otherwise(hh * 100 + mm).cast("int").alias("CRS_DEP_TIME"),
        unless(cxl, (F.floor(t / 60) * 100 + t % 60).cast("double")).alias("DEP_TIME"),
        unless(cxl, dd.cast("double")).alias("DEP_DELAY"),
        unless(cxl, (5 + z % 30).cast("double")).alias("TAXI_OUT"),
        unless(cxl, ((z % 24) * 100 + x % 60).cast("double")).alias("WHEELS_OFF"),
        unless(lost, ((x % 24) * 100 + z % 60).cast("double")).alias("WHEELS_ON"),
        unless(lost, (2 + z % 15).cast("double")).alias("TAXI_IN"),
        unless(lost, ((y % 24) * 100 + z % 60).cast("double")).alias("ARR_TIME"),
        unless(lost, (dd + (y % 31) - 18).cast("double")).alias("ARR_DELAY"),
        F.when(cxl, F.lit(1.0)).otherwise(F.lit(0.0)).alias("CANCELLED"),
        (100 + z % 2500).cast("double").alias("DISTANCE"),
        extra(x).alias("EXTRA_1"),
        extra(y).alias("EXTRA_2"),
        extra(z).alias("EXTRA_3"),
        F.when(x % 9 == 0, F.lit(0.0)).alias("EXTRA_4"),
        F.when(x % 9 == 0, (y % 7).cast("double")).alias("EXTRA_5"),
        F.lit(None).cast("string").alias("EXTRA_6"),
    )


# Customers fall into this many airports, by key; the sum of an
# airport's nation keys picks its nation.
AIRPORTS = 120
NATIONS = 25


def airports_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Airport lookup (Airport, City, State, IATA) from all customers and nation.

    A partial aggregate over the whole table leaves one row for each airport.
    That makes the result ``AIRPORTS`` rows at most whatever the input, so it
    is marked for broadcast here, where the bound is known. ``nation`` is a
    plain file scan, for which the planner's byte statistics decide.
    """
    grouped = customer.groupBy((F.col("c_custkey") % AIRPORTS).alias("key")).agg(
        (F.sum("c_nationkey") % NATIONS).cast("int").alias("nation_key")
    )
    key = F.col("key")
    lookup = grouped.join(
        nation.select("n_nationkey", "n_name"), grouped.nation_key == F.col("n_nationkey"), "inner"
    ).select(
        _code("Airport ", key, 3).alias("Airport"),
        F.concat(F.lit("City "), (key % 80).cast("string")).alias("City"),
        F.col("n_name").alias("State"),
        _code("A", key, 3).alias("IATA"),
    )
    return F.broadcast(lookup)


def load_flights(spark, sf_dir: str) -> DataFrame:
    return flights_from_lineitem(read_parquet(spark, sf_dir, "lineitem", LINEITEM_SOURCE_SCHEMA))


def load_airports(spark, sf_dir: str) -> DataFrame:
    return airports_from_customers(
        read_parquet(spark, sf_dir, "customer", CUSTOMER_SOURCE_SCHEMA),
        read_parquet(spark, sf_dir, "nation", NATION_SOURCE_SCHEMA),
    )
