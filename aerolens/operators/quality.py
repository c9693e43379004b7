"""Profiling and pruning: null shares (A18), shape (S5), preview (S6),
column drops (P1, P2).

Each profile is one aggregate job, whatever the column count: the counts are
partial aggregates computed inside every scan task and merged once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.sources.schemas import TRAILING_COLUMNS


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: for every column, the share of null values in percent.

    ``nulls / rows * 100`` in double arithmetic. An empty frame gives null
    instead of a division-by-zero error.
    """
    total = F.count(F.lit(1)).cast("double")
    return df.select(
        *[
            (F.try_divide(F.count(F.when(F.col(c).isNull(), F.lit(1))).cast("double"), total)
             * F.lit(100.0)).alias(c)
            for c in df.columns
        ]
    )


def null_percentages_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The null profile of every group (A18 for each year in one job)."""
    total = F.count(F.lit(1)).cast("double")
    shares = [
        (F.count(F.when(F.col(c).isNull(), F.lit(1))).cast("double") / total * F.lit(100.0)).alias(c)
        for c in df.columns
        if c not in keys
    ]
    return df.groupBy(*keys).agg(*shares)


def shape(df: DataFrame) -> DataFrame:
    """One row with the row count and the column count."""
    return df.select(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows (S6): of ``order`` (nulls first), of which every task
    keeps n rows, or else whichever the scan brings first."""
    return (df.orderBy(*(F.col(c).asc_nulls_first() for c in order)) if order else df).limit(n)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the named columns; names not present are ignored."""
    return df.drop(*columns)


def drop_trailing(df: DataFrame, n: int = TRAILING_COLUMNS) -> DataFrame:
    """Drop the last ``n`` columns by position."""
    return df.drop(*df.columns[-n:]) if n > 0 else df
