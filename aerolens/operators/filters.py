"""Row filters (P6-P10) and the model column selection.

Filters are plain predicates, so Catalyst merges adjacent ones and pushes
them into the Parquet scan. The year filter is written as a date range on
FL_DATE as well as an equality on Year: the range reaches the scan's row-group
statistics, the equality prunes Year partitions of a stored table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: flights with either delay at or above this many minutes are
# treated as outliers and removed before labelling.
OUTLIER_MINUTES = 400

# The columns the classifiers use, label last.
MODEL_COLUMNS = [
    "OP_CARRIER", "ORIGIN", "DEST", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON",
    "TAXI_IN", "DEP_TIME", "DEP_DELAY", "Labels",
]


def not_cancelled(df: DataFrame) -> DataFrame:
    """Keep flights with CANCELLED != 1 (P6); a null CANCELLED is dropped too."""
    return df.filter(F.col("CANCELLED") != 1)


def remove_outliers(df: DataFrame, minutes: float = OUTLIER_MINUTES) -> DataFrame:
    """Keep ARR_DELAY < minutes AND DEP_DELAY < minutes (P7); nulls are dropped."""
    return df.filter((F.col("ARR_DELAY") < minutes) & (F.col("DEP_DELAY") < minutes))


def for_year(df: DataFrame, year: int | str, date_col: str = "FL_DATE") -> DataFrame:
    """Rows of one calendar year."""
    year = int(year)
    cond = None
    if date_col in df.columns:
        start, end = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
        cond = (F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end))
    if "Year" in df.columns:
        by_year = F.col("Year") == F.lit(year)
        cond = by_year if cond is None else cond & by_year
    if cond is None:
        raise ValueError(f"neither {date_col} nor Year is a column")
    return df.filter(cond)


def for_destination_state(df: DataFrame, state: str) -> DataFrame:
    """Flights into one destination state (P9); the state is a literal, never pasted SQL."""
    return df.filter(F.col("DestinationState") == F.lit(state))


def with_part_of_day_only(df: DataFrame) -> DataFrame:
    """Drop flights with no part of day (P10)."""
    return df.filter(F.col("Parts_of_day").isNotNull())


def select_model_columns(df: DataFrame, keep_year: bool = False, keep_key: bool = False) -> DataFrame:
    """The ten classifier columns (P3); ``keep_year`` carries Year for a split
    by year, ``keep_key`` what else the split tells rows apart by."""
    cols = MODEL_COLUMNS + (["Year"] if keep_year else []) + (["FL_DATE", "CRS_DEP_TIME"] if keep_key else [])
    return df.select(*cols)
