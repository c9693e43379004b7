from aerolens.functions.calendar import (
    DAY_PARTS,
    LAST_DAY_PART,
    SEASON_MONTHS,
    calendar_columns,
    part_of_day,
    season,
    with_calendar,
    with_part_of_day,
    with_season,
)
from aerolens.functions.labels import delay_label, with_labels

__all__ = [
    "DAY_PARTS",
    "LAST_DAY_PART",
    "SEASON_MONTHS",
    "calendar_columns",
    "delay_label",
    "part_of_day",
    "season",
    "with_calendar",
    "with_labels",
    "with_part_of_day",
    "with_season",
]
