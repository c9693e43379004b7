"""Named queries over the driver's tables and their DuckDB oracle SQL."""

from aerolens.plans.catalog import queries
from aerolens.plans.oracle import oracle_sql
from aerolens.plans.tables import enriched_flights, labelled_flights, model_input, store_enriched

__all__ = ["enriched_flights", "labelled_flights", "model_input", "oracle_sql", "queries", "store_enriched"]
