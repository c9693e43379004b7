"""Top-k helpers: global top-k (T2) and top-k per group by dense rank.

Global top-k plans as ``TakeOrderedAndProject``: every task keeps its own k
best rows and only those are merged, so nothing but k rows per task moves.

Top-k per group filters ``dense_rank() <= k``; Catalyst plans this with a
partial ``WindowGroupLimit`` before the shuffle and a final one after it, so
each task forwards at most the rows of its k best ranks per group. Dense rank
keeps ties, so a group can return more than k rows.

The place of every row in a global order (T1) comes from the sort's own range
partitions: places inside a partition plus the sizes of the partitions before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolens.session import checkpoint_dir, stable


def key_order(cols: Sequence[str]) -> list[Column]:
    """Ascending order on key columns with nulls first: a full, stable tie-break."""
    return [F.col(c).asc_nulls_first() for c in cols]


def top_k(df: DataFrame, k: int, measure: str, keys: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``measure``; ties at the cut broken by ``keys``."""
    return df.orderBy(F.col(measure).desc(), *key_order(keys)).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    measure: str,
    k: int,
    output: Sequence[str],
) -> DataFrame:
    """Rows whose ``measure`` is among the k largest distinct values of their group."""
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc())
    ranked = df.withColumn("_rnk", F.dense_rank().over(w))
    return ranked.filter(F.col("_rnk") <= k).select(*output)


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, in the global ``order`` (T1);
    rows that tie in all of it get their places in any order.

    A sort deals the rows to range partitions. They are written to the shared
    checkpoint folder with the number of their partition and their place in it,
    since the sort's sampled bounds could differ if it were run again. What is
    gathered in one place is a size for each partition; the offsets (as many
    rows, no more than ``spark.sql.shuffle.partitions``) are broadcast."""
    if not checkpoint_dir(df.sparkSession):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = F.col("_at")
    # The partition in the upper bits, the place inside it in the lower 33.
    ranged = stable(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"_part": F.shiftright(at, 33), "_place": at.bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    placed = ranged.join(F.broadcast(offsets), "_part")
    return placed.select(*df.columns, (F.col("_offset") + F.col("_place") + 1).alias(name))
