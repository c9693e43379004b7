"""The enriched flights table, built from the driver's tables or stored once.

Every report reads the same enriched flights. Built lazily, each report
recomputes the enrichment inside its own scan; that is a narrow projection
plus two broadcast lookups, so it costs one columnar scan of the five source
columns. For repeated reporting over a large table, ``store_enriched`` writes
it once as Parquet partitioned by Year, after which a year filter prunes
whole folders and every report reads only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolens.operators.enrich import enrich
from aerolens.operators.filters import not_cancelled, remove_outliers, select_model_columns
from aerolens.functions.labels import with_labels
from aerolens.sources.fixture import load_airports, load_flights
from aerolens.sources.sinks import write_table


def enriched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived flights with trailing columns dropped, city/state, calendar,
    season and part of day."""
    return enrich(load_flights(spark, sf_dir), load_airports(spark, sf_dir))


def labelled_flights(enriched: DataFrame) -> DataFrame:
    """Flown flights without delay outliers, with the class label."""
    return with_labels(remove_outliers(not_cancelled(enriched)))


def model_input(enriched: DataFrame) -> DataFrame:
    """The classifier columns of the labelled flights, Year kept for splitting."""
    return select_model_columns(labelled_flights(enriched), keep_year=True)


def model_rows(enriched: DataFrame) -> DataFrame:
    """``model_input`` with the columns that place a row in the split."""
    return select_model_columns(labelled_flights(enriched), keep_year=True, keep_key=True)


def store_enriched(enriched: DataFrame, path: str, replace: str = "table") -> str:
    """Write the enriched table, partitioned by Year: all of it, or with
    ``replace="partitions"`` only the years that ``enriched`` holds."""
    return write_table(enriched, path, partition_by=["Year"], replace=replace)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
