"""Airport lookup join (J1) and the full enrichment chain.

Enrichment is narrow: two left joins against a small broadcast lookup and a
handful of column expressions. The flights table is read once, is never
shuffled, and keeps every row (unmatched or null codes get null city and
state).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.functions.calendar import with_calendar, with_part_of_day, with_season
from aerolens.operators.quality import drop_trailing

# Columns the enrichment adds, in output order.
LOCATION_COLUMNS = ["OriginCity", "OriginState", "DestinationCity", "DestinationState"]
CALENDAR_COLUMNS = ["Year", "Month", "Day", "Day_Name", "Day_OfWeek"]


def map_state_city(
    flights: DataFrame,
    airports: DataFrame,
    trim_state: bool = False,
) -> DataFrame:
    """Add OriginCity, OriginState, DestinationCity, DestinationState.

    Two left equi-joins of the flights against the same lookup, ORIGIN = IATA
    then DEST = IATA. The lookup is projected to the three columns it
    contributes. Whether it is broadcast is decided where it is loaded: by a
    hint where its size is bounded by construction, else by the planner from
    the file's byte statistics (``spark.sql.autoBroadcastJoinThreshold``) and
    at run time by adaptive execution, which also splits skewed keys of a
    shuffle join. No job runs here. ``trim_state`` strips blanks around state
    names (off by default: names are kept as spelt in the file).
    """
    state = F.trim(F.col("State")) if trim_state else F.col("State")
    lookup = airports.select(F.col("IATA"), F.col("City"), state.alias("State"))
    origin = lookup.select(
        F.col("IATA").alias("_o_code"),
        F.col("City").alias("OriginCity"),
        F.col("State").alias("OriginState"),
    )
    dest = lookup.select(
        F.col("IATA").alias("_d_code"),
        F.col("City").alias("DestinationCity"),
        F.col("State").alias("DestinationState"),
    )
    out = flights.join(origin, flights["ORIGIN"] == origin["_o_code"], "left")
    out = out.join(dest, out["DEST"] == dest["_d_code"], "left")
    return out.select(*flights.columns, *LOCATION_COLUMNS)


#: Share of the flights from which a code counts as hot, so there are at most
#: 1 / HOT_SHARE hot codes; and places that rows of a hot or null code go to.
HOT_SHARE = 0.005
SALTS = 256


def unique_lookup(airports: DataFrame) -> DataFrame:
    """One row for each code; rows without a code, which match nothing, go. A code
    that stands twice with the same city and state is one, with others it makes
    the query fail: it would multiply flights."""
    named = F.struct("City", "State")
    one = airports.filter(F.col("IATA").isNotNull()).groupBy("IATA").agg(
        F.min(named).alias("_one"), F.max(named).alias("_other")
    )
    twice = F.raise_error(F.concat(F.lit("airport code with several places: "), F.col("IATA")))
    checked = F.when(F.col("_one").eqNullSafe(F.col("_other")), F.col("_one")).otherwise(twice)
    return one.select("IATA", checked.alias("_place")).select("IATA", "_place.City", "_place.State")


def hot_codes(flights: DataFrame, code: str, share: float = HOT_SHARE) -> DataFrame:
    """Codes of more than ``share`` of the flights: fewer than 1 / share rows."""
    counts = flights.groupBy(code).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col(code).isNotNull() & (F.col("_n") > F.lit(share) * total)).select(F.col(code).alias("_hot"))


def salted_lookup(
    flights: DataFrame, code: str, lookup: DataFrame, adds: Sequence[str], hot: DataFrame, row_hash: Column, salts: int
) -> DataFrame:
    """``flights`` with the columns ``adds`` of ``lookup`` (unique by IATA), joined
    by a shuffle that no code makes uneven.

    Flights of ``hot`` codes (counted, see ``hot_codes``) go to ``salts`` places by
    a hash of the row, and so do flights without a code, which match nothing; the
    lookup's rows of hot codes, and of no others, are repeated for each place."""
    hot = F.broadcast(hot)  # fewer than 1 / share rows
    spread = F.pmod(row_hash, F.lit(salts)).cast("int")
    dealt = flights.join(hot, F.col(code) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | F.col(code).isNull(), spread).otherwise(F.lit(0))
    )
    each = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    side = lookup.join(hot, F.col("IATA") == F.col("_hot"), "left").select(
        F.col("IATA").alias("_code"), *adds, F.explode(each).alias("_place")
    )
    found = dealt.join(side, (F.col(code) == F.col("_code")) & (F.col("_salt") == F.col("_place")), "left")
    return found.select(*flights.columns, *adds)


def map_state_city_by_shuffle(
    flights: DataFrame, airports: DataFrame, share: float = HOT_SHARE, salts: int = SALTS
) -> DataFrame:
    """J1 for lookups without a size bound: the columns of ``map_state_city`` from
    two salted shuffle joins, with a guard against repeated codes."""
    lookup = unique_lookup(airports)
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in flights.columns))
    out = flights
    for code, city, state in (("ORIGIN", "OriginCity", "OriginState"), ("DEST", "DestinationCity", "DestinationState")):
        side = lookup.select("IATA", F.col("City").alias(city), F.col("State").alias(state))
        out = salted_lookup(out, code, side, [city, state], hot_codes(flights, code, share), row_hash, salts)
    return out


def enrich(
    flights: DataFrame,
    airports: DataFrame,
    drop_trailing_columns: bool = True,
) -> DataFrame:
    """Clean and enrich raw flights: drop the trailing columns (P2), add city
    and state (J1), calendar columns (F1-F3), Seasons (F4), Parts_of_day (F5)."""
    base = drop_trailing(flights) if drop_trailing_columns else flights
    out = map_state_city(base, airports)
    out = with_calendar(out)
    out = with_season(out)
    return with_part_of_day(out)
