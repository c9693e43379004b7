"""Calendar, season and part-of-day columns.

All are built-in expressions, so they compile into the scan's generated code
and add no pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month groups of the four seasons.
SEASON_MONTHS = {
    "SPRING": (3, 4, 5),
    "SUMMER": (6, 7, 8),
    "AUTUMN": (9, 10, 11),
    "WINTER": (12, 1, 2),
}

# Parts of the day by scheduled departure clock time (hhmm),
# each [low, high) except the last, which is [1800, 2359] closed. 2400,
# negative and null times fall in no part.
DAY_PARTS = (
    ("Early Morning", 0, 400),
    ("Morning", 400, 1200),
    ("Afternoon", 1200, 1800),
)
LAST_DAY_PART = ("Evening/Night", 1800, 2359)


def calendar_columns(date_col: str = "FL_DATE") -> dict[str, Column]:
    """Year, Month, Day, Day_Name (full English name), Day_OfWeek (1 = Sunday)."""
    d = F.col(date_col)
    return {
        "Year": F.year(d),
        "Month": F.month(d),
        "Day": F.dayofmonth(d),
        "Day_Name": F.date_format(d, "EEEE"),
        "Day_OfWeek": F.dayofweek(d),
    }


def with_calendar(df: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    return df.withColumns(calendar_columns(date_col))


def season(month: Column) -> Column:
    """Season name of a month number; null for anything else."""
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_season(df: DataFrame, month_col: str = "Month") -> DataFrame:
    return df.withColumn("Seasons", season(F.col(month_col)))


def part_of_day(hhmm: Column) -> Column:
    """Part of the day of an hhmm clock time; null outside [0, 2359]."""
    expr = None
    for name, low, high in DAY_PARTS:
        cond = (hhmm >= low) & (hhmm < high)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    name, low, high = LAST_DAY_PART
    return expr.when((hhmm >= low) & (hhmm <= high), F.lit(name))


def with_part_of_day(df: DataFrame, time_col: str = "CRS_DEP_TIME") -> DataFrame:
    return df.withColumn("Parts_of_day", part_of_day(F.col(time_col)))
