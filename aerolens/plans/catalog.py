"""Named queries over the driver's tables: name -> callable(spark, sf_dir).

Each query reads the given parquet tables (through the derived flights and
airports views) and returns a DataFrame. Jobs run while a query is built only
where models or encoders are fitted, files are written or headers read, or a
sorted frame is written for its positions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolens.operators import distribution, filters, ml, quality, reports
from aerolens.operators.enrich import LOCATION_COLUMNS, map_state_city_by_shuffle
from aerolens.operators.setops import combine
from aerolens.operators.topk import key_order, with_position
from aerolens.plans import single_pass
from aerolens.plans.modeling import (
    feature_vectors,
    model_comparison,
    perceptron_scores,
    rule_scores,
    stratified_split_counts,
    vector_summary,
)
from aerolens.plans.tables import (
    enriched_flights,
    labelled_flights,
    model_input,
    model_rows,
    read_enriched,
    store_enriched,
)
from aerolens.session import checkpoint_dir
from aerolens.sources.files import parse_lines, read_flights, register, rendered_lines
from aerolens.sources.fixture import load_airports, load_flights
from aerolens.sources.schemas import FIXTURE_FLIGHTS_SCHEMA

# The parameters the registered reports run with.
STATE_A = "NATION_5"
STATE_B = "NATION_7"
ONE_YEAR = 1998
SPLIT_DATE = "1998-07-01"

Query = Callable[[SparkSession, str], DataFrame]


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_flights(spark, sf_dir)


def _report(fn, **kwargs) -> Query:
    return lambda spark, sf_dir: fn(_enriched(spark, sf_dir), **kwargs)


def _flown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.not_cancelled(_enriched(spark, sf_dir))


def _union_by_name_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned flights as three frames, before a date, since, and
    undated, each with its columns in another order, put together by name.
    The predicates cover every row once; three scans, no job while planning."""
    flights = quality.drop_trailing(load_flights(spark, sf_dir))
    date, since = F.col("FL_DATE"), F.lit(SPLIT_DATE).cast("date")
    columns = flights.columns
    return combine(
        flights.filter(date < since),
        flights.filter(date >= since).select(columns[::-1]),
        flights.filter(date.isNull()).select(sorted(columns)),
    )


def _flights_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 on a table that has Year but no date."""
    return filters.for_year(_enriched(spark, sf_dir).drop("FL_DATE"), ONE_YEAR)


def _null_percentages_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = load_flights(spark, sf_dir)
    return quality.null_percentages_by(flights.withColumn("Year", F.year("FL_DATE")), ["Year"])


def _registered_carrier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched flights under a name of their own, read by SQL."""
    name = f"flights_{uuid.uuid4().hex}"
    register(_enriched(spark, sf_dir), name)
    try:
        return spark.sql(f"SELECT OP_CARRIER, COUNT(*) AS Number FROM {name} GROUP BY OP_CARRIER")
    finally:
        spark.catalog.dropTempView(name)


def _single_pass_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished report out of the shared aggregate."""
    aggs = single_pass.report_aggregates(_enriched(spark, sf_dir))
    return single_pass.reports_from_aggregates(aggs, STATE_A, STATE_B)["carrier_average_delays"]


#: CSV layout of the lines that ``lineitem`` is rendered to.
LINE_SCHEMA = "FL_DATE date, OP_CARRIER string, ORIGIN string, DEP_DELAY double, ARR_DELAY double, DISTANCE double"


def _parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights rendered to CSV lines, some spoilt by a rule (every 97th
    distance isn't a number, dates of the 31st don't exist), and parsed back."""
    columns = LINE_SCHEMA.replace(",", "").split()[::2]
    flights = load_flights(spark, sf_dir)
    text = flights.select(*(F.col(c).cast("string").alias(c) for c in columns))
    day = F.when(F.dayofmonth("FL_DATE") == 31, F.concat(F.substring("FL_DATE", 1, 5), F.lit("02-31")))
    text = text.withColumns({
        "DISTANCE": F.when(F.col("DISTANCE").cast("double") % 97 == 0, F.lit("far")).otherwise(F.col("DISTANCE")),
        "FL_DATE": F.coalesce(day, F.col("FL_DATE")),
    })
    lines = text.select(rendered_lines(text, columns).alias("line"))
    parsed = parse_lines(lines, "line", LINE_SCHEMA)
    return parsed.groupBy("OP_CARRIER").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("_malformed").alias("malformed"),
        F.count("FL_DATE").alias("dates"),
        F.count("ARR_DELAY").alias("arrivals"),
        F.sum("DISTANCE").alias("distance"),
        F.sum("DEP_DELAY").alias("delay"),
        F.max("FL_DATE").alias("latest"),
    )


def _folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    shared = checkpoint_dir(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared}/{uuid.uuid4().hex}"


def _flights_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights written as CSV files of three layouts (as declared,
    reversed with a column more, without the trailing ones) and read by header."""
    folder, flights = _folder(spark), load_flights(spark, sf_dir)
    lots = {
        "declared": flights.filter(F.year("FL_DATE") < ONE_YEAR),
        "reversed": flights.filter(F.year("FL_DATE") == ONE_YEAR).select(flights.columns[::-1]).withColumn("more", F.lit(1)),
        "shorter": quality.drop_trailing(flights.filter(F.year("FL_DATE") > ONE_YEAR)),
    }
    for name, lot in lots.items():
        lot.write.option("header", True).csv(f"{folder}/{name}")
    return quality.drop_trailing(read_flights(spark, f"{folder}/*", FIXTURE_FLIGHTS_SCHEMA))


def _stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table stored by Year, then one year stored anew with its
    long flights only."""
    enriched = _enriched(spark, sf_dir)
    path = store_enriched(enriched, f"{_folder(spark)}/enriched")
    store_enriched(filters.for_year(enriched, ONE_YEAR).filter("DISTANCE >= 1000"), path, replace="partitions")
    stored = read_enriched(spark, path)
    return stored.groupBy("Year").agg(
        F.count(F.lit(1)).alias("Number"), F.sum("DISTANCE").alias("distance"), F.count("OriginState").alias("origins")
    )


def _flights_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight's place in the order of all its columns."""
    flights = quality.drop_trailing(load_flights(spark, sf_dir))
    return with_position(flights, key_order(flights.columns))


def _flights_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 in the order of all columns."""
    flights = quality.drop_trailing(load_flights(spark, sf_dir))
    return quality.preview(flights, 20, flights.columns)


def _located_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 without a broadcast lookup: flights by origin and destination place."""
    flights = quality.drop_trailing(load_flights(spark, sf_dir)).select("ORIGIN", "DEST", "FL_DATE", "DISTANCE")
    located = map_state_city_by_shuffle(flights, load_airports(spark, sf_dir))
    return located.groupBy("ORIGIN", "DEST", *LOCATION_COLUMNS).agg(
        F.count(F.lit(1)).alias("Number"), F.sum("DISTANCE").alias("distance")
    )


def _split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: a three-way seeded split, counted."""
    lots = ml.split_data(model_rows(_enriched(spark, sf_dir)), (0.5, 0.3, 0.2), seed=7)
    counted = [
        lot.groupBy("Year").agg(F.count(F.lit(1)).alias("Number")).withColumn("lot", F.lit(k)) for k, lot in enumerate(lots)
    ]
    return combine(*counted)


def _label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_flights(_enriched(spark, sf_dir))
    return labelled.groupBy("Labels").agg(F.count(F.lit(1)).alias("Number"))


def queries() -> dict[str, Query]:
    return {
        # sources, enrichment, quality
        "enriched_flights": _enriched,
        "null_percentages": lambda s, d: quality.null_percentages(load_flights(s, d)),
        "flights_shape": lambda s, d: quality.shape(load_flights(s, d)),
        "drop_trailing_columns": lambda s, d: quality.drop_trailing(load_flights(s, d)),
        "union_by_name_years": _union_by_name_years,
        "null_percentages_per_year": _null_percentages_per_year,
        "drop_named_columns": lambda s, d: quality.drop_columns(load_flights(s, d), ["EXTRA_1", "DISTANCE", "absent"]),
        "flights_in_year": _flights_in_year,
        "registered_carrier_counts": _registered_carrier_counts,
        "parsed_lines": _parsed_lines,
        "flights_from_files": _flights_from_files,
        "stored_table": _stored_table,
        "flights_preview": _flights_preview,
        "flights_in_order": _flights_in_order,
        "located_by_shuffle": _located_by_shuffle,
        # reports
        "flights_per_month_in_year": _report(reports.flights_per_month, year=ONE_YEAR),
        "flights_per_carrier_in_year": _report(reports.flights_per_carrier, year=ONE_YEAR),
        "flights_per_weekday_in_year": _report(reports.flights_per_weekday, year=ONE_YEAR),
        "top_destination_states_in_year": _report(reports.top_destination_states, year=ONE_YEAR),
        "top_destination_states_per_year": _report(reports.top_destination_states_per_year),
        "top_origins": _report(reports.top_origins),
        "flights_per_month": _report(reports.flights_per_month),
        "flights_per_carrier": _report(reports.flights_per_carrier),
        "top_destination_states": _report(reports.top_destination_states),
        "top_states_per_year": _report(reports.top_states_per_year),
        "top_cities_in_state_per_year": _report(reports.top_cities_in_state_per_year, state=STATE_A),
        "two_state_comparison": _report(reports.two_state_comparison, state1=STATE_A, state2=STATE_B),
        "flights_per_weekday": _report(reports.flights_per_weekday),
        "top_carriers_per_weekday": _report(reports.top_carriers_per_weekday),
        "top_carriers_per_year": _report(reports.top_carriers_per_year),
        "carrier_average_delays": _report(reports.carrier_average_delays),
        "airport_departure_delay": _report(reports.airport_departure_delay),
        "airport_taxi_out": _report(reports.airport_taxi_out),
        "carrier_distance_per_year": _report(reports.carrier_distance_per_year),
        "top_states_per_season": _report(reports.top_states_per_season),
        "parts_of_day_share": _report(reports.parts_of_day_share),
        "top_origin_pairs_by_daypart": _report(reports.top_origin_pairs_by_daypart),
        "top_destination_pairs_by_daypart": _report(reports.top_destination_pairs_by_daypart),
        # the base measures of all reports from one scan (GROUPING SETS)
        "single_pass_carrier_delays": _single_pass_carriers,
        "report_aggregates": lambda s, d: single_pass.report_aggregates(_enriched(s, d)),
        # cleaning and labels
        "flown_flights": _flown,
        "without_outliers": lambda s, d: labelled_flights(_enriched(s, d)),
        "model_input": lambda s, d: model_input(_enriched(s, d)),
        "label_counts": _label_counts,
        # distribution
        "delay_box_summary": lambda s, d: distribution.box_summary(_flown(s, d)),
        "delay_outliers": lambda s, d: distribution.delay_outliers(_flown(s, d)),
        "outlier_histogram": lambda s, d: distribution.outlier_histogram(_flown(s, d)),
        # ML; fitted models have no SQL oracle, what goes into them and how
        # they are scored has
        "stratified_split_counts": lambda s, d: stratified_split_counts(model_rows(_enriched(s, d))),
        "split_counts": _split_counts,
        "feature_vectors": lambda s, d: feature_vectors(model_rows(_enriched(s, d))),
        "vector_summary": lambda s, d: vector_summary(model_rows(_enriched(s, d))),
        "classification_scores": lambda s, d: rule_scores(labelled_flights(_enriched(s, d))),
        "model_comparison": lambda s, d: model_comparison(model_rows(_enriched(s, d))),
        "perceptron_scores": lambda s, d: perceptron_scores(model_rows(_enriched(s, d))),
    }


__all__ = ["STATE_A", "STATE_B", "queries"]
