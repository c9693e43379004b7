"""The aggregate reports (A1-A17) over the enriched flights table.

Every report is one grouped aggregation, planned as a partial aggregate inside
each scan task (so a hot key, however large, leaves each task as one row)
followed by a final aggregate after a shuffle of those partial rows. Ranking,
limits and ordering then run on the aggregated result, whose size is bounded
by the dimension sizes (years x states, carriers, airports, city pairs), not
by the number of flights.

Each report is split in two: its aggregate (``groupBy(...).agg(...)``) and a
``finish_*`` step that ranks, limits and orders the aggregated rows. The
finishing steps are shared with the single-pass report run
(``aerolens.plans.reporting``), which computes all aggregates in one scan.

Counting rules are part of the semantics: ``COUNT(DEP_TIME)`` counts flown
flights (DEP_TIME is null when a flight did not leave), ``COUNT(*)`` counts
scheduled ones.

Reports whose reference form takes a year (A2, A3, A4, A8) accept
``year=None``; for A2, A3 and A8 that computes the report for every year in
one aggregation, grouped by Year, instead of one job per year. For A4 it means
all years together; ``top_destination_states_per_year`` has every year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolens.operators.filters import for_destination_state, for_year, with_part_of_day_only
from aerolens.operators.topk import top_k, top_k_per_group


def _flown() -> Column:
    return F.count("DEP_TIME")


def _rows() -> Column:
    return F.count(F.lit(1))


def _scope(df: DataFrame, year: int | None) -> tuple[DataFrame, list[str]]:
    """Filter to one year, or keep all years and group by Year as well."""
    if year is None:
        return df, ["Year"]
    return for_year(df, year), []


# A1 ---------------------------------------------------------------------------

def top_origins(df: DataFrame, k: int = 15) -> DataFrame:
    """A1: departures per ORIGIN (``COUNT(ORIGIN)``), the k busiest."""
    return finish_top_origins(df.groupBy("ORIGIN").agg(F.count("ORIGIN").alias("Number")), k)


def finish_top_origins(agg: DataFrame, k: int = 15) -> DataFrame:
    return top_k(agg, k, "Number", ["ORIGIN"])


# A2, A3, A8 ---------------------------------------------------------------------

def flights_per_month(df: DataFrame, year: int | None = None) -> DataFrame:
    """A2: scheduled flights per Month (per Year and Month when ``year`` is None)."""
    scoped, extra = _scope(df, year)
    return finish_per_month(scoped.groupBy(*extra, "Month").agg(_rows().alias("Number")))


def finish_per_month(agg: DataFrame) -> DataFrame:
    return agg.orderBy(*[c for c in ("Year", "Month") if c in agg.columns])


def flights_per_carrier(df: DataFrame, year: int | None = None) -> DataFrame:
    """A3: scheduled flights per OP_CARRIER, fewest first."""
    scoped, extra = _scope(df, year)
    return finish_per_carrier(scoped.groupBy(*extra, "OP_CARRIER").agg(_rows().alias("Number")))


def finish_per_carrier(agg: DataFrame) -> DataFrame:
    year = ["Year"] if "Year" in agg.columns else []
    return agg.orderBy(*year, "Number", "OP_CARRIER")


def flights_per_weekday(df: DataFrame, year: int | None = None) -> DataFrame:
    """Scheduled flights per Day_Name, most first."""
    scoped, extra = _scope(df, year)
    return finish_per_weekday(scoped.groupBy(*extra, "Day_Name").agg(_rows().alias("Number")))


def finish_per_weekday(agg: DataFrame) -> DataFrame:
    year = ["Year"] if "Year" in agg.columns else []
    return agg.orderBy(*year, F.desc("Number"), "Day_Name")


# A4 ---------------------------------------------------------------------------

def top_destination_states(df: DataFrame, k: int = 10, year: int | None = None) -> DataFrame:
    """A4: flown flights per DestinationState (null state is a group), the k largest."""
    scoped = df if year is None else for_year(df, year)
    agg = scoped.groupBy("DestinationState").agg(_flown().alias("Number"))
    return finish_top_destination_states(agg, k)


def finish_top_destination_states(agg: DataFrame, k: int = 10) -> DataFrame:
    return top_k(agg, k, "Number", ["DestinationState"])


def top_destination_states_per_year(df: DataFrame, k: int = 10) -> DataFrame:
    """A4 for every year from one aggregate: the k largest states of each Year."""
    agg = df.groupBy("Year", "DestinationState").agg(_flown().alias("Number"))
    return finish_top_destination_states_per_year(agg, k)


def finish_top_destination_states_per_year(agg: DataFrame, k: int = 10) -> DataFrame:
    """Exactly k rows a year, ties at the cut broken by state, as in ``top_k``."""
    w = Window.partitionBy("Year").orderBy(F.col("Number").desc(), F.col("DestinationState").asc_nulls_first())
    cut = agg.withColumn("_row", F.row_number().over(w)).filter(F.col("_row") <= k)
    return cut.select("Year", "DestinationState", "Number").orderBy(
        "Year", F.desc("Number"), F.col("DestinationState").asc_nulls_first()
    )


# A5, A6, A10, A15 -----------------------------------------------------------------

def top_states_per_year(df: DataFrame, k: int = 5) -> DataFrame:
    """A5: flown flights per Year and DestinationState, top k by dense rank in each Year."""
    agg = df.groupBy("Year", "DestinationState").agg(_flown().alias("Number"))
    return finish_top_states_per_year(agg, k)


def finish_top_states_per_year(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(agg, ["Year"], "Number", k, ["Year", "DestinationState", "Number"])
    return top.orderBy("Year", F.desc("Number"), "DestinationState")


def top_cities_in_state_per_year(df: DataFrame, state: str, k: int = 5) -> DataFrame:
    """A5 by DestinationCity, for flights into one state."""
    agg = (
        for_destination_state(df, state)
        .groupBy("Year", "DestinationCity")
        .agg(_flown().alias("Number"))
    )
    return finish_top_cities_per_year(agg, k)


def finish_top_cities_per_year(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(agg, ["Year"], "Number", k, ["Year", "DestinationCity", "Number"])
    return top.orderBy("Year", F.desc("Number"), "DestinationCity")


def top_carriers_per_year(df: DataFrame, k: int = 5) -> DataFrame:
    """A10: flown flights per Year and OP_CARRIER, top k by dense rank in each Year."""
    agg = df.groupBy("Year", "OP_CARRIER").agg(_flown().alias("Number"))
    return finish_top_carriers_per_year(agg, k)


def finish_top_carriers_per_year(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(agg, ["Year"], "Number", k, ["Year", "OP_CARRIER", "Number"])
    return top.orderBy("Year", F.desc("Number"), "OP_CARRIER")


def top_states_per_season(df: DataFrame, k: int = 5) -> DataFrame:
    """Flown flights per Seasons and DestinationState, top k by dense rank per season."""
    agg = df.groupBy("Seasons", "DestinationState").agg(_flown().alias("NumberOfFlightsFlown"))
    return finish_top_states_per_season(agg, k)


def finish_top_states_per_season(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(
        agg, ["Seasons"], "NumberOfFlightsFlown", k,
        ["Seasons", "DestinationState", "NumberOfFlightsFlown"],
    )
    return top.orderBy("Seasons", F.desc("NumberOfFlightsFlown"), "DestinationState")


# A7 ---------------------------------------------------------------------------

def two_state_comparison(df: DataFrame, state1: str, state2: str) -> DataFrame:
    """Per Year, flown flights into ``state1`` (State1) and ``state2`` (State2).

    Only years in which both states have at least one flight row appear (the
    inner-join semantics of two per-state aggregates), computed here in one
    scan with one conditional aggregation instead of two scans and a join.
    """
    state = F.col("DestinationState")
    is1, is2 = state == F.lit(state1), state == F.lit(state2)
    per_year = (
        df.filter(state.isin(state1, state2))
        .groupBy("Year")
        .agg(
            F.count(F.when(is1, F.col("DEP_TIME"))).alias("State1"),
            F.count(F.when(is2, F.col("DEP_TIME"))).alias("State2"),
            F.count(F.when(is1, F.lit(1))).alias("_rows1"),
            F.count(F.when(is2, F.lit(1))).alias("_rows2"),
        )
    )
    return finish_two_state_comparison(per_year)


def pivot_two_states(agg: DataFrame, state1: str, state2: str) -> DataFrame:
    """(Year, DestinationState, flown, rows) aggregated per state, turned into
    the per-year form ``finish_two_state_comparison`` takes."""
    state = F.col("DestinationState")
    is1, is2 = state == F.lit(state1), state == F.lit(state2)
    return (
        agg.filter(state.isin(state1, state2))
        .groupBy("Year")
        .agg(
            F.coalesce(F.sum(F.when(is1, F.col("flown"))), F.lit(0)).alias("State1"),
            F.coalesce(F.sum(F.when(is2, F.col("flown"))), F.lit(0)).alias("State2"),
            F.coalesce(F.sum(F.when(is1, F.col("rows"))), F.lit(0)).alias("_rows1"),
            F.coalesce(F.sum(F.when(is2, F.col("rows"))), F.lit(0)).alias("_rows2"),
        )
    )


def finish_two_state_comparison(per_year: DataFrame) -> DataFrame:
    """Keep years where both states have rows; (Year, State1, State2) by Year."""
    both = per_year.filter((F.col("_rows1") > 0) & (F.col("_rows2") > 0))
    return both.select("Year", "State1", "State2").orderBy("Year")


# A9 ---------------------------------------------------------------------------

def top_carriers_per_weekday(df: DataFrame, k: int = 5) -> DataFrame:
    """Flown flights per Day_Name and OP_CARRIER, top k by dense rank in each day."""
    agg = df.groupBy("Day_Name", "OP_CARRIER", "Day_OfWeek").agg(_flown().alias("Number"))
    return finish_top_carriers_per_weekday(agg, k)


def finish_top_carriers_per_weekday(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(
        agg, ["Day_Name"], "Number", k, ["Day_Name", "OP_CARRIER", "Day_OfWeek", "Number"]
    )
    return top.orderBy("Day_OfWeek", F.desc("Number"), "OP_CARRIER")


# A11 --------------------------------------------------------------------------

def carrier_average_delays(df: DataFrame, k: int = 5) -> DataFrame:
    """The k carriers with most flown flights, with their average delays."""
    agg = df.groupBy("OP_CARRIER").agg(
        _flown().alias("NumberOfFlightsFlown"),
        F.avg("DEP_DELAY").alias("AverageDepartureDelay"),
        F.avg("ARR_DELAY").alias("AverageArrivalDelay"),
    )
    return finish_carrier_average_delays(agg, k)


def finish_carrier_average_delays(agg: DataFrame, k: int = 5) -> DataFrame:
    return top_k(agg, k, "NumberOfFlightsFlown", ["OP_CARRIER"])


# A12, A13 -----------------------------------------------------------------------

def _airport_average(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    agg = df.groupBy("Year", "ORIGIN").agg(
        _flown().alias("NumberOfFlightsFlown"), F.avg(value).alias(name)
    )
    return finish_airport_average(agg, name, k)


def finish_airport_average(agg: DataFrame, name: str, k: int = 5) -> DataFrame:
    """Rank (Year, ORIGIN) rows by flown count, return the average ``name``."""
    top = top_k_per_group(agg, ["Year"], "NumberOfFlightsFlown", k, ["Year", "ORIGIN", name])
    return top.orderBy("Year", F.desc(name), "ORIGIN")


def airport_departure_delay(df: DataFrame, k: int = 5) -> DataFrame:
    """Average departure delay of each Year's k busiest origins (ranked by flown count)."""
    return _airport_average(df, "DEP_DELAY", "AverageDepartureDelay", k)


def airport_taxi_out(df: DataFrame, k: int = 5) -> DataFrame:
    """Average taxi-out time of each Year's k busiest origins."""
    return _airport_average(df, "TAXI_OUT", "AverageTakeOff", k)


# A14 --------------------------------------------------------------------------

def carrier_distance_per_year(df: DataFrame, k: int = 5) -> DataFrame:
    """Total distance per carrier and Year, top k by dense rank of the distance."""
    agg = df.groupBy("OP_CARRIER", "Year").agg(
        _flown().alias("NumberOfFlightsFlown"),
        F.sum("DISTANCE").alias("TotalDistanceTravelled"),
    )
    return finish_carrier_distance_per_year(agg, k)


def finish_carrier_distance_per_year(agg: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(
        agg, ["Year"], "TotalDistanceTravelled", k, ["OP_CARRIER", "Year", "TotalDistanceTravelled"]
    )
    return top.orderBy("Year", F.desc("TotalDistanceTravelled"), "OP_CARRIER")


# A16 --------------------------------------------------------------------------

def parts_of_day_share(df: DataFrame) -> DataFrame:
    """Scheduled flights per part of day (null part left out) and the share in percent."""
    agg = with_part_of_day_only(df).groupBy("Parts_of_day").agg(_rows().alias("Number"))
    return finish_parts_of_day_share(agg)


def finish_parts_of_day_share(agg: DataFrame) -> DataFrame:
    """The share's window has no partition key; it runs over the aggregated
    result, which has at most four rows."""
    agg = with_part_of_day_only(agg)
    total = F.sum("Number").over(Window.partitionBy())
    share = F.col("Number").cast("double") * F.lit(100.0) / total.cast("double")
    return agg.withColumn("Share", share).orderBy(F.desc("Number"), "Parts_of_day")


# A17 --------------------------------------------------------------------------

def city_pairs_by_daypart(df: DataFrame) -> DataFrame:
    """Shared aggregate of A17: per Parts_of_day, OriginCity and DestinationCity,
    flown departures (OriginCount) and recorded arrivals (DestCount)."""
    return df.groupBy("Parts_of_day", "OriginCity", "DestinationCity").agg(
        F.count("DEP_TIME").alias("OriginCount"),
        F.count("ARR_TIME").alias("DestCount"),
    )


def finish_origin_pairs(pairs: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(
        pairs, ["Parts_of_day"], "OriginCount", k, ["Parts_of_day", "OriginCity", "OriginCount"]
    )
    return top.orderBy("Parts_of_day", F.desc("OriginCount"), "OriginCity")


def finish_destination_pairs(pairs: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_per_group(
        pairs, ["Parts_of_day"], "DestCount", k, ["Parts_of_day", "DestinationCity", "DestCount"]
    )
    return top.orderBy("Parts_of_day", F.desc("DestCount"), "DestinationCity")


def top_origin_pairs_by_daypart(df: DataFrame, k: int = 5, pairs: DataFrame | None = None) -> DataFrame:
    """OriginCity of the city pairs ranked top k by departures in each part of day.

    Ranking is over (origin, destination) pairs, so a city can appear more
    than once; the null part of day is a group of its own.
    """
    return finish_origin_pairs(city_pairs_by_daypart(df) if pairs is None else pairs, k)


def top_destination_pairs_by_daypart(
    df: DataFrame, k: int = 5, pairs: DataFrame | None = None
) -> DataFrame:
    """DestinationCity of the city pairs ranked top k by arrivals in each part of day."""
    return finish_destination_pairs(city_pairs_by_daypart(df) if pairs is None else pairs, k)


def top_cities_by_daypart(df: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Both halves from one shared pair aggregate."""
    pairs = city_pairs_by_daypart(df)
    return finish_origin_pairs(pairs, k), finish_destination_pairs(pairs, k)
