from aerolens.sources.files import read_airports, read_csv, read_flights, read_parquet, register
from aerolens.sources.fixture import (
    airports_from_customers,
    flights_from_lineitem,
    load_airports,
    load_flights,
)
from aerolens.sources.schemas import (
    AIRPORTS_SCHEMA,
    FIXTURE_FLIGHTS_SCHEMA,
    FLIGHTS_CSV_SCHEMA,
    TRAILING_COLUMNS,
)
from aerolens.sources.sinks import write_report, write_table

__all__ = [
    "AIRPORTS_SCHEMA",
    "FIXTURE_FLIGHTS_SCHEMA",
    "FLIGHTS_CSV_SCHEMA",
    "TRAILING_COLUMNS",
    "airports_from_customers",
    "flights_from_lineitem",
    "load_airports",
    "load_flights",
    "read_airports",
    "read_csv",
    "read_flights",
    "read_parquet",
    "register",
    "write_report",
    "write_table",
]
