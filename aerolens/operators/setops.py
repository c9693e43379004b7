"""Union by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def combine(*frames: DataFrame, allow_missing_columns: bool = False) -> DataFrame:
    """Fold of ``unionByName``: columns matched by name, duplicates kept.

    A union is a narrow operation (partitions are concatenated, nothing
    shuffles). For yearly files one ``read_flights`` over all paths is the
    cheaper way; this is for frames from different sources.
    """
    if not frames:
        raise ValueError("nothing to combine")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing_columns), frames
    )
