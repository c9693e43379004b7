"""Execution patterns to compare the library's plans with (bench.py).

A script that draws charts tends to run one job for each profiled column, to
run a report again for each list that it pulls to the driver, and to collect
whole columns. Each function below puts such a pattern on top of the library's
own frames; no query is restated here.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.operators import distribution, filters, quality, reports
from aerolens.plans.catalog import STATE_A, STATE_B
from aerolens.plans.tables import enriched_flights
from aerolens.sources.fixture import load_flights


def pull_lists(report: DataFrame) -> list[list]:
    """Every column of a report as a list, each by a run of its own."""
    return [[row[0] for row in report.select(column).collect()] for column in report.columns]


def null_percentages(spark, sf_dir):
    flights = load_flights(spark, sf_dir)
    return [quality.null_percentages(flights.select(c)).collect() for c in flights.columns]


def top_origins(spark, sf_dir):
    return pull_lists(reports.top_origins(enriched_flights(spark, sf_dir)))


def top_states_per_year(spark, sf_dir):
    return pull_lists(reports.top_states_per_year(enriched_flights(spark, sf_dir)))


def two_state_comparison(spark, sf_dir):
    """One filtered job for each state and year instead of one aggregate."""
    flights = enriched_flights(spark, sf_dir)
    years = pull_lists(reports.flights_per_month(flights).select("Year").distinct())[0]
    return [
        [filters.for_destination_state(filters.for_year(flights, y), s).agg(F.count("DEP_TIME")).collect() for y in years]
        for s in (STATE_A, STATE_B)
    ]


def delay_distribution(spark, sf_dir):
    """Both delay columns on the driver, summarised by numpy."""
    flown = filters.not_cancelled(enriched_flights(spark, sf_dir))
    out = {}
    for c in distribution.DELAY_COLUMNS:
        x = np.asarray(flown.select(F.collect_list(c)).first()[0], dtype=float)
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        reach = distribution.WHISKER_IQR * (q3 - q1)
        beyond = x[x > q3 + reach]
        out[c] = (q1, median, q3, x.mean(), x[x < q1 - reach], beyond, np.histogram(beyond, distribution.HISTOGRAM_BINS))
    return out


SHAPES = {
    "null_percentages": null_percentages,
    "top_origins": top_origins,
    "top_states_per_year": top_states_per_year,
    "two_state_comparison": two_state_comparison,
    "delay_distribution": delay_distribution,
}

# Library queries that together produce what each pattern produces.
LIBRARY_EQUIVALENT = {name: [name] for name in SHAPES if name != "delay_distribution"} | {
    "delay_distribution": ["delay_box_summary", "delay_outliers", "outlier_histogram"]
}


def library_delay_reports(spark, sf_dir):
    """All three delay outputs at once, from one shared histogram."""
    flown = filters.not_cancelled(enriched_flights(spark, sf_dir))
    for frame in distribution.delay_reports(flown).values():
        frame.write.format("noop").mode("overwrite").save()


# Patterns compared with one combined library call instead of separate queries.
LIBRARY_COMBINED = {"delay_distribution": library_delay_reports}
