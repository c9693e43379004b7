"""Box-plot summary, outliers and outlier histogram of the delays.

Nothing is pulled to the driver. The delay columns are unpivoted to
(delay, value) rows and reduced to a value histogram, one row per distinct
(delay, value) with its frequency ``n``. That reduction is a partial
aggregate inside every scan task, so a value held by a third of all flights
still leaves each task as one row. Quantiles, whisker caps, outlier counts and
the outlier bins are all computed from the histogram, whose size is bounded
by the number of distinct delay values (delays are whole minutes), not by the
number of flights. The outlier rows (D3) are the histogram's rows beyond the
fences, each as often as its value occurs, so the flights are read once.

The statistics follow the usual box-plot rules: quartiles by linear
interpolation, fences at 1.5 x IQR beyond the quartiles, whisker caps at the
most extreme values inside the fences (never inside the box), outliers beyond
the fences; ten equal-width bins from the smallest to the largest upper
outlier, the last bin closed on the right.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolens.session import stable

# The delay columns summarised, the whisker length in IQRs and
# the number of histogram bins.
DELAY_COLUMNS = ("ARR_DELAY", "DEP_DELAY")
WHISKER_IQR = 1.5
HISTOGRAM_BINS = 10


def delay_values(df: DataFrame, columns: Sequence[str] = DELAY_COLUMNS) -> DataFrame:
    """Long form (delay, value) of the delay columns, nulls dropped."""
    long = df.select(*columns).unpivot([], list(columns), "delay", "value")
    return long.filter(F.col("value").isNotNull())


def value_histogram(df: DataFrame, columns: Sequence[str] = DELAY_COLUMNS) -> DataFrame:
    """(delay, value, n): frequency of every distinct value of every delay column."""
    return delay_values(df, columns).groupBy("delay", "value").agg(F.count(F.lit(1)).alias("n"))


QUARTILES = (0.25, 0.5, 0.75)


#: Ranges that an e-fold of a delay's size is cut into, each about 0.1 % wide.
RANGES_PER_E = 1024


def value_range(value: Column) -> Column:
    """The number of the fixed range that a value lies in. Of two values the
    larger one never lies in the lower range (Java's log1p and floor keep the
    order), so ranges partition the values whatever they are. There are some
    1.5 million ranges in all, and whole minutes up to about a thousand have a
    range each."""
    size = F.floor(F.log1p(F.abs(value)) * F.lit(RANGES_PER_E))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(value < 0, -size).otherwise(size)


def _quartiles(
    hist: DataFrame,
    whisker: float,
    values: DataFrame | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Per delay: count, q1, median, q3, mean and the two fences.

    Exact by default (``_ranked_quartiles``). With ``accuracy`` the quartiles
    come from ``percentile_approx`` over the raw ``values``, a fixed-size sketch.
    """
    v, n = F.col("value"), F.col("n")
    if accuracy is None:
        return _with_fences(_ranked_quartiles(hist), whisker)
    if values is None:
        raise ValueError("approximate quartiles need the raw values")
    side = values.groupBy("delay").agg(
        F.percentile_approx(v, list(QUARTILES), accuracy).cast("array<double>").alias("_q")
    )
    q = hist.groupBy("delay").agg(
        F.sum(n).alias("count"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
    )
    # One row per delay column on each side: a bounded broadcast.
    return _with_fences(q.join(F.broadcast(side), "delay"), whisker)


def _ranked_quartiles(hist: DataFrame) -> DataFrame:
    """count, mean and ``_q``, the quartiles, of each delay column.

    The histogram is cut into fixed ranges by value. A running total over the
    ranges' totals (never more rows than there are ranges) gives the first rank
    of each and so the ranges that own the ranks wanted, at most two for each
    quartile. Only these are sorted by value, each in a place of its own. One
    plan, no step on the driver, and no task sees all values of a column."""
    v, n = F.col("value"), F.col("n")
    ranged = hist.withColumn("_range", value_range(v))
    ranges = ranged.groupBy("delay", "_range").agg(F.sum("n").alias("_held"), F.sum(v * n).alias("_sum"))
    totals = ranges.groupBy("delay").agg(
        F.sum("_held").alias("count"), (F.sum("_sum") / F.sum("_held")).alias("mean")
    )
    upto = Window.partitionBy("delay").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_held").over(upto), F.lit(0))
    # One row per delay column: a bounded broadcast.
    placed = ranges.withColumn("_first", first).join(F.broadcast(totals), "delay")
    places = [F.lit(p) * (F.col("count") - 1) for p in QUARTILES]

    def holds(begin: Column, many: Column, rank: Column) -> Column:
        return (begin <= rank) & (rank < begin + many)

    owns = reduce(
        or_, [holds(F.col("_first"), F.col("_held"), edge(place)) for place in places for edge in (F.floor, F.ceil)]
    )
    owners = placed.filter(owns).select("delay", F.col("_range").alias("_own"), "_first", "count", "mean")
    # At most two ranges for each quartile of each delay column: a bounded broadcast.
    # Null-safe, so that no filter on the range goes below the histogram, whose
    # shuffle all branches share.
    searched = ranged.join(
        F.broadcast(owners), (ranged["delay"] == owners["delay"]) & F.col("_range").eqNullSafe(F.col("_own"))
    ).drop(owners["delay"])
    before = Window.partitionBy("delay", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    searched = searched.withColumn("_begin", F.col("_first") + F.coalesce(F.sum("n").over(before), F.lit(0)))

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(F.col("_begin"), n, rank), v))

    pieces = []
    for k, place in enumerate(places):
        pieces += [at(F.floor(place)).alias(f"_low{k}"), at(F.ceil(place)).alias(f"_high{k}")]
    found = searched.groupBy("delay", "count", "mean").agg(*pieces)

    def between(k: int) -> Column:
        low, high, place = F.col(f"_low{k}"), F.col(f"_high{k}"), places[k]
        share = place - F.floor(place)
        # Linear interpolation, weighting both neighbours as Spark's percentile does.
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + share * high)

    return found.select("delay", "count", "mean", F.array(*map(between, range(len(QUARTILES)))).alias("_q"))


def _with_fences(q: DataFrame, whisker: float) -> DataFrame:
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    iqr = q3 - q1
    return q.select(
        "delay", "count",
        q1.alias("q1"), F.col("_q")[1].alias("median"), "mean", q3.alias("q3"),
        (q1 - F.lit(whisker) * iqr).alias("lower_fence"),
        (q3 + F.lit(whisker) * iqr).alias("upper_fence"),
    )


def _fenced(frame: DataFrame, stats: DataFrame) -> DataFrame:
    # ``stats`` is grouped by ``delay``, whose values are the caller's column
    # names: at most len(columns) rows, so the broadcast is bounded.
    return frame.join(F.broadcast(stats), "delay")


def box_summary(
    df: DataFrame,
    columns: Sequence[str] = DELAY_COLUMNS,
    whisker: float = WHISKER_IQR,
    hist: DataFrame | None = None,
    accuracy: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """One row per delay column with count, minimum and maximum
    (whisker caps), q1, median, mean, q3, the fences and the outlier counts.

    The quartiles are computed once, broadcast back onto the histogram and
    carried through the second aggregate as grouping columns (they are
    functions of ``delay``), so the plan has one quartile aggregate and no
    join after it. ``hist`` is a precomputed ``value_histogram`` to reuse;
    ``accuracy`` chooses how the quartiles are computed (see ``_quartiles``).
    """
    hist = value_histogram(df, columns) if hist is None else hist
    if stats is None:
        stats = _quartiles(hist, whisker, delay_values(df, columns), accuracy)
    v, n = F.col("value"), F.col("n")
    lo, hi = F.col("lower_fence"), F.col("upper_fence")
    out = _fenced(hist, stats).groupBy(*stats.columns).agg(
        F.min(F.when(v >= lo, v)).alias("_low_in"),
        F.max(F.when(v <= hi, v)).alias("_high_in"),
        F.coalesce(F.sum(F.when(v < lo, n)), F.lit(0)).alias("lower_outliers"),
        F.coalesce(F.sum(F.when(v > hi, n)), F.lit(0)).alias("upper_outliers"),
    )
    q1, q3 = F.col("q1"), F.col("q3")
    low_in, high_in = F.col("_low_in"), F.col("_high_in")
    minimum = F.when(low_in.isNull() | (low_in > q1), q1).otherwise(low_in)
    maximum = F.when(high_in.isNull() | (high_in < q3), q3).otherwise(high_in)
    return out.select(
        "delay", "count", minimum.alias("minimum"), "q1", "median", "mean", "q3",
        maximum.alias("maximum"), "lower_fence", "upper_fence",
        "lower_outliers", "upper_outliers",
    )


def delay_outliers(
    df: DataFrame,
    columns: Sequence[str] = DELAY_COLUMNS,
    whisker: float = WHISKER_IQR,
    hist: DataFrame | None = None,
    accuracy: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """D3: one row per outlier value (delay, side, value); a value below q1 is
    'lower', any other 'upper'."""
    hist = value_histogram(df, columns) if hist is None else hist
    if stats is None:
        stats = _quartiles(hist, whisker, delay_values(df, columns), accuracy)
    v = F.col("value")
    rows = _fenced(hist, stats)
    rows = rows.filter((v < F.col("lower_fence")) | (v > F.col("upper_fence")))
    side = F.when(v < F.col("q1"), F.lit("lower")).otherwise(F.lit("upper"))
    # A value that occurs very often is written out in two steps, so that no
    # row carries a list longer than ``step``.
    step = 10_000
    rows = rows.select("delay", side.alias("side"), "value", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / step))).alias("_lot"))
    left = F.least(F.lit(step), F.col("n") - F.col("_lot") * step)
    return rows.select("delay", "side", "value", F.explode(F.sequence(F.lit(1), left)).alias("_copy")).drop("_copy")


def _bin_index(value: Column, first: Column, step: Column, bins: int) -> Column:
    """Index of the bin holding ``value``: the number of inner edges at or below it.

    Edge i is ``i * step + first``, the same arithmetic as an evenly spaced
    edge array, so a value on an edge lands in the bin that edge opens.
    """
    inner = [(value >= F.lit(float(i)) * step + first).cast("int") for i in range(1, bins)]
    return reduce(add, inner) if inner else F.lit(0)


def outlier_histogram(
    df: DataFrame,
    columns: Sequence[str] = DELAY_COLUMNS,
    whisker: float = WHISKER_IQR,
    bins: int = HISTOGRAM_BINS,
    hist: DataFrame | None = None,
    accuracy: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Equal-width bins over the upper outliers of each delay column.

    Rows (delay, bin, bin_start, bin_end, count); empty bins are listed with
    count 0. When all upper outliers are equal the range is widened by 0.5 on
    each side; with no upper outlier it is [0, 1] and every count is 0.
    """
    v = F.col("value")
    hist = value_histogram(df, columns) if hist is None else hist
    if stats is None:
        stats = _quartiles(hist, whisker, delay_values(df, columns), accuracy)
    fenced = _fenced(hist, stats)
    is_upper = v > F.col("upper_fence")
    upper = fenced.filter(is_upper).select("delay", "value", "n")
    # Every delay with any value has a row here, even with no upper outlier.
    # ``n > 0`` holds for every histogram row; referencing ``n`` keeps column
    # pruning from dropping the frequency in this branch, so both branches
    # share one histogram shuffle (a reused exchange) instead of scanning twice.
    in_range = is_upper & (F.col("n") > 0)
    spans = fenced.groupBy("delay").agg(
        F.min(F.when(in_range, v)).alias("_lo"), F.max(F.when(in_range, v)).alias("_hi")
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    first = F.when(lo.isNull(), F.lit(0.0)).when(lo == hi, lo - 0.5).otherwise(lo)
    last = F.when(hi.isNull(), F.lit(1.0)).when(lo == hi, hi + 0.5).otherwise(hi)
    ranges = spans.select(
        "delay", first.alias("first"), last.alias("last"),
        ((last - first) / F.lit(float(bins))).alias("step"),
    )
    first_c, last_c, step_c = F.col("first"), F.col("last"), F.col("step")
    counts = (
        _fenced(upper, ranges)
        .withColumn("bin", _bin_index(v, first_c, step_c, bins))
        .groupBy("delay", "bin")
        .agg(F.sum("n").alias("count"))
    )
    b = F.col("bin")
    edges = ranges.select(
        "delay", "first", "last", "step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "delay", "bin",
        (b.cast("double") * step_c + first_c).alias("bin_start"),
        F.when(b == bins - 1, last_c).otherwise((b + 1).cast("double") * step_c + first_c).alias("bin_end"),
    )
    # ``counts`` has at most len(columns) x bins rows: a bounded broadcast.
    out = edges.join(F.broadcast(counts), ["delay", "bin"], "left")
    return out.select(
        "delay", "bin", "bin_start", "bin_end",
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    ).orderBy("delay", "bin")


def delay_reports(
    df: DataFrame,
    columns: Sequence[str] = DELAY_COLUMNS,
    whisker: float = WHISKER_IQR,
    bins: int = HISTOGRAM_BINS,
    accuracy: int | None = None,
) -> dict[str, DataFrame]:
    """D1-D4 together: the value histogram and the quartile stats are each
    computed and materialised once (both are small), and the summary and the
    bins are computed from them, the outlier rows as well; ``df`` is read once."""
    hist = stable(value_histogram(df, columns))
    stats = stable(_quartiles(hist, whisker, delay_values(df, columns), accuracy))
    return {
        "delay_box_summary": box_summary(df, columns, whisker, hist, stats=stats),
        "delay_outliers": delay_outliers(df, columns, whisker, hist, stats=stats),
        "outlier_histogram": outlier_histogram(df, columns, whisker, bins, hist, stats=stats),
    }
