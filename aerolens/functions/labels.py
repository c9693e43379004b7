"""Arrival-delay class label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class names and the minute bounds between them.
EARLY, ON_TIME, DELAY = "Early", "OnTime", "Delay"
EARLY_BELOW = -10
DELAY_ABOVE = 10


def delay_label(arr_delay: Column) -> Column:
    """Early below -10 minutes, Delay above 10, OnTime otherwise (null included)."""
    return (
        F.when(arr_delay < EARLY_BELOW, F.lit(EARLY))
        .when(arr_delay > DELAY_ABOVE, F.lit(DELAY))
        .otherwise(F.lit(ON_TIME))
    )


def with_labels(df: DataFrame, delay_col: str = "ARR_DELAY") -> DataFrame:
    return df.withColumn("Labels", delay_label(F.col(delay_col)))
