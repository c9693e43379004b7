"""All aggregate reports from one scan (GROUPING SETS).

Run one at a time, the seventeen reports scan the enriched table seventeen
times. Here one ``groupingSets`` aggregate computes the base measures of
every report in a single scan: each input row is expanded once per grouping
set inside the scan task and folded into a partial aggregate, so one shuffle
of partial rows serves all reports. The result is small (the sum of the
reports' group counts, bounded by the dimensions), is materialised once, and
each report is a slice of it passed to the same ``finish_*`` step as the
standalone report.

Averages are carried as (sum, non-null count) pairs and divided at the end,
which is how ``avg`` evaluates. Sets whose reports need only counts and that
are coarser than another set are rolled up from it after the aggregate, so
every input row is expanded only for the sets that need it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.operators import reports as R
from aerolens.session import stable

# Grouping sets: name -> grouping columns. Every input row is expanded once
# per set, so the list holds only sets that cannot be rolled up from another.
REPORT_KEYS: dict[str, tuple[str, ...]] = {
    "year_month": ("Year", "Month"),
    "year_carrier": ("Year", "OP_CARRIER"),
    "year_day": ("Year", "Day_Name"),
    "year_state_city": ("Year", "DestinationState", "DestinationCity"),
    "day_carrier": ("Day_Name", "OP_CARRIER", "Day_OfWeek"),
    "carrier": ("OP_CARRIER",),
    "year_origin": ("Year", "ORIGIN"),
    "season_state": ("Seasons", "DestinationState"),
    "daypart_pair": ("Parts_of_day", "OriginCity", "DestinationCity"),
}

# Count-only sets rolled up from a finer set of the aggregate (sums of counts
# are exact): name -> (finer set, grouping columns kept).
ROLLUPS: dict[str, tuple[str, tuple[str, ...]]] = {
    "origin": ("year_origin", ("ORIGIN",)),
    "year_state": ("year_state_city", ("Year", "DestinationState")),
    "dest_state": ("year_state_city", ("DestinationState",)),
    "daypart": ("daypart_pair", ("Parts_of_day",)),
}
COUNT_MEASURES = ("scheduled", "flown", "arrived", "origins")
KEY_COLUMNS: list[str] = list(dict.fromkeys(c for keys in REPORT_KEYS.values() for c in keys))


def _set_id(keys: Sequence[str]) -> int:
    """``grouping_id()`` of a set: one bit per key column, first column most
    significant, set when the column is not grouped."""
    gid = 0
    for c in KEY_COLUMNS:
        gid = (gid << 1) | (0 if c in keys else 1)
    return gid


def report_aggregates(enriched: DataFrame) -> DataFrame:
    """One row per group of every grouping set, with all base measures."""
    return enriched.groupingSets([list(k) for k in REPORT_KEYS.values()], *KEY_COLUMNS).agg(
        F.count(F.lit(1)).alias("scheduled"),
        F.count("DEP_TIME").alias("flown"),
        F.count("ARR_TIME").alias("arrived"),
        F.count("ORIGIN").alias("origins"),
        F.sum("DEP_DELAY").alias("dep_delay_sum"),
        F.count("DEP_DELAY").alias("dep_delay_n"),
        F.sum("ARR_DELAY").alias("arr_delay_sum"),
        F.count("ARR_DELAY").alias("arr_delay_n"),
        F.sum("TAXI_OUT").alias("taxi_out_sum"),
        F.count("TAXI_OUT").alias("taxi_out_n"),
        F.sum("DISTANCE").alias("distance"),
        F.grouping_id().alias("set_id"),
    )


def _set_rows(aggs: DataFrame, name: str) -> DataFrame:
    """Rows of one grouping set (or of a roll-up of a finer one), with their
    grouping columns and the base measures."""
    if name in ROLLUPS:
        finer, keys = ROLLUPS[name]
        return _set_rows(aggs, finer).groupBy(*keys).agg(
            *[F.sum(m).alias(m) for m in COUNT_MEASURES]
        )
    keys = REPORT_KEYS[name]
    return aggs.filter(F.col("set_id") == F.lit(_set_id(keys)))


def _slice(aggs: DataFrame, name: str, **measures: Column) -> DataFrame:
    keys = ROLLUPS[name][1] if name in ROLLUPS else REPORT_KEYS[name]
    rows = _set_rows(aggs, name)
    return rows.select(*keys, *[expr.alias(alias) for alias, expr in measures.items()])


def _avg(prefix: str) -> Column:
    return F.try_divide(F.col(f"{prefix}_sum"), F.col(f"{prefix}_n").cast("double"))


def reports_from_aggregates(
    aggs: DataFrame,
    state_a: str,
    state_b: str,
    years: Sequence[int] = (),
    k: int = 5,
) -> dict[str, DataFrame]:
    """Every aggregate report (A1-A17) as a slice of ``report_aggregates``."""
    scheduled, flown = F.col("scheduled"), F.col("flown")
    pairs = _slice(aggs, "daypart_pair", OriginCount=flown, DestCount=F.col("arrived"))
    year_state = _slice(aggs, "year_state", Number=flown)
    out = {
        "top_origins": R.finish_top_origins(_slice(aggs, "origin", Number=F.col("origins"))),
        "flights_per_month": R.finish_per_month(_slice(aggs, "year_month", Number=scheduled)),
        "flights_per_carrier": R.finish_per_carrier(_slice(aggs, "year_carrier", Number=scheduled)),
        "top_destination_states": R.finish_top_destination_states(
            _slice(aggs, "dest_state", Number=flown)
        ),
        "flights_per_weekday": R.finish_per_weekday(_slice(aggs, "year_day", Number=scheduled)),
        "top_states_per_year": R.finish_top_states_per_year(year_state, k),
        "top_cities_in_state_per_year": R.finish_top_cities_per_year(
            _slice(aggs, "year_state_city", Number=flown)
            .filter(F.col("DestinationState") == F.lit(state_a))
            .drop("DestinationState"),
            k,
        ),
        "two_state_comparison": R.finish_two_state_comparison(
            R.pivot_two_states(_slice(aggs, "year_state", flown=flown, rows=scheduled), state_a, state_b)
        ),
        "top_carriers_per_weekday": R.finish_top_carriers_per_weekday(
            _slice(aggs, "day_carrier", Number=flown), k
        ),
        "top_carriers_per_year": R.finish_top_carriers_per_year(
            _slice(aggs, "year_carrier", Number=flown), k
        ),
        "carrier_average_delays": R.finish_carrier_average_delays(
            _slice(
                aggs, "carrier", NumberOfFlightsFlown=flown,
                AverageDepartureDelay=_avg("dep_delay"), AverageArrivalDelay=_avg("arr_delay"),
            ),
            k,
        ),
        "airport_departure_delay": R.finish_airport_average(
            _slice(aggs, "year_origin", NumberOfFlightsFlown=flown, AverageDepartureDelay=_avg("dep_delay")),
            "AverageDepartureDelay", k,
        ),
        "airport_taxi_out": R.finish_airport_average(
            _slice(aggs, "year_origin", NumberOfFlightsFlown=flown, AverageTakeOff=_avg("taxi_out")),
            "AverageTakeOff", k,
        ),
        "carrier_distance_per_year": R.finish_carrier_distance_per_year(
            _slice(aggs, "year_carrier", NumberOfFlightsFlown=flown, TotalDistanceTravelled=F.col("distance")),
            k,
        ),
        "top_states_per_season": R.finish_top_states_per_season(
            _slice(aggs, "season_state", NumberOfFlightsFlown=flown), k
        ),
        "parts_of_day_share": R.finish_parts_of_day_share(_slice(aggs, "daypart", Number=scheduled)),
        "top_origin_pairs_by_daypart": R.finish_origin_pairs(pairs, k),
        "top_destination_pairs_by_daypart": R.finish_destination_pairs(pairs, k),
    }
    per_year = R.finish_top_destination_states_per_year(year_state)
    out["top_destination_states_per_year"] = (
        per_year.filter(F.col("Year").isin([int(y) for y in years])) if years else per_year
    )
    return out


def all_reports(
    enriched: DataFrame,
    state_a: str,
    state_b: str,
    years: Sequence[int] = (),
    k: int = 5,
) -> dict[str, DataFrame]:
    """Compute the shared aggregate once (materialised) and slice every report from it."""
    return reports_from_aggregates(stable(report_aggregates(enriched)), state_a, state_b, years, k)
