"""The single-pass report run must equal the standalone reports exactly."""

import pytest

from aerolens.operators import reports as R
from aerolens.plans import single_pass
from aerolens.plans.catalog import STATE_A, STATE_B
from aerolens.plans.tables import enriched_flights
from conftest import SF_ORACLE, rows


@pytest.fixture(scope="module")
def both(spark):
    enriched = enriched_flights(spark, SF_ORACLE)
    shared = single_pass.all_reports(enriched, STATE_A, STATE_B, years=[1998])
    standalone = {
        "top_origins": R.top_origins(enriched),
        "flights_per_month": R.flights_per_month(enriched),
        "flights_per_carrier": R.flights_per_carrier(enriched),
        "top_destination_states": R.top_destination_states(enriched),
        "flights_per_weekday": R.flights_per_weekday(enriched),
        "top_states_per_year": R.top_states_per_year(enriched),
        "top_cities_in_state_per_year": R.top_cities_in_state_per_year(enriched, STATE_A),
        "two_state_comparison": R.two_state_comparison(enriched, STATE_A, STATE_B),
        "top_carriers_per_weekday": R.top_carriers_per_weekday(enriched),
        "top_carriers_per_year": R.top_carriers_per_year(enriched),
        "carrier_average_delays": R.carrier_average_delays(enriched),
        "airport_departure_delay": R.airport_departure_delay(enriched),
        "airport_taxi_out": R.airport_taxi_out(enriched),
        "carrier_distance_per_year": R.carrier_distance_per_year(enriched),
        "top_states_per_season": R.top_states_per_season(enriched),
        "parts_of_day_share": R.parts_of_day_share(enriched),
        "top_origin_pairs_by_daypart": R.top_origin_pairs_by_daypart(enriched),
        "top_destination_pairs_by_daypart": R.top_destination_pairs_by_daypart(enriched),
        "top_destination_states_per_year": R.top_destination_states_per_year(enriched).filter("Year = 1998"),
    }
    return shared, standalone


def test_every_report_is_covered(both):
    shared, standalone = both
    assert set(shared) == set(standalone)


@pytest.mark.parametrize("name", [
    "top_origins", "flights_per_month", "flights_per_carrier", "top_destination_states",
    "flights_per_weekday", "top_states_per_year", "top_cities_in_state_per_year",
    "two_state_comparison", "top_carriers_per_weekday", "top_carriers_per_year",
    "carrier_average_delays", "airport_departure_delay", "airport_taxi_out",
    "carrier_distance_per_year", "top_states_per_season", "parts_of_day_share",
    "top_origin_pairs_by_daypart", "top_destination_pairs_by_daypart",
    "top_destination_states_per_year",
])
def test_single_pass_equals_standalone(both, name):
    shared, standalone = both
    assert shared[name].columns == standalone[name].columns
    # Same rows in the same presentation order.
    assert rows(shared[name]) == rows(standalone[name])


def test_one_scan_for_all_aggregates(spark):
    plan = single_pass.report_aggregates(enriched_flights(spark, SF_ORACLE))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet [l_orderkey") == 1
    assert "Expand" in text and "partial_count" in text
