"""A hot key holding a third of all rows: results stay whole and exact, and
the plans pre-aggregate before any shuffle, so the hot key leaves every
scan task as one row."""

import numpy as np
from pyspark.sql import functions as F

from aerolens.operators import distribution as D
from aerolens.operators import reports as R
from conftest import rows


def skewed(spark, n=30000):
    # A third of all flights share one origin, one state and one delay value.
    return spark.range(n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .otherwise(F.concat(F.lit("A"), (F.col("id") % 97).cast("string"))).alias("ORIGIN"),
        F.when(F.col("id") % 3 == 0, F.lit("S0"))
        .otherwise(F.concat(F.lit("T"), (F.col("id") % 11).cast("string"))).alias("DestinationState"),
        (F.lit(1990) + F.col("id") % 4).cast("int").alias("Year"),
        F.lit(1.0).alias("DEP_TIME"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") % 61 - 20).cast("double")).alias("ARR_DELAY"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") % 997).cast("double")).alias("DEP_DELAY"),
    )


def test_hot_key_counts_are_whole(spark):
    df = skewed(spark)
    top = dict(rows(R.top_origins(df, k=3)))
    assert top["HOT"] == 10000
    per_year = rows(R.top_states_per_year(df, k=1))
    assert all(state == "S0" and n == 2500 for _, state, n in per_year)


def test_hot_value_in_box_summary(spark):
    df = skewed(spark)
    got = {r["delay"]: r for r in D.box_summary(df).collect()}
    arr = np.asarray([r[0] for r in df.select("ARR_DELAY").collect()])
    q1, med, q3 = np.percentile(arr, [25, 50, 75])
    assert (got["ARR_DELAY"]["q1"], got["ARR_DELAY"]["median"], got["ARR_DELAY"]["q3"]) == (q1, med, q3)
    assert got["ARR_DELAY"]["count"] == 30000


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    plan = R.top_origins(skewed(spark))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(ORIGIN" in l)
    assert "partial_count" in lines[exchange + 1]
    hist_plan = D.box_summary(skewed(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in hist_plan  # (delay, value) histogram folded per task
