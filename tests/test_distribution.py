import numpy as np
import pytest

from pyspark.sql import functions as F

from aerolens.operators import distribution as D
from conftest import rows


def brute_box(values, whis=1.5):
    """Box-plot statistics by the usual rules, computed directly with numpy."""
    x = np.asarray([v for v in values if v is not None], dtype=float)
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo, hi = q1 - whis * iqr, q3 + whis * iqr
    low_in = x[x >= lo]
    high_in = x[x <= hi]
    whislo = q1 if len(low_in) == 0 or low_in.min() > q1 else low_in.min()
    whishi = q3 if len(high_in) == 0 or high_in.max() < q3 else high_in.max()
    fliers = x[(x < whislo) | (x > whishi)]
    lower = sorted(float(f) for f in fliers if f < q1)
    upper = sorted(float(f) for f in fliers if f >= q1)
    return dict(count=len(x), minimum=whislo, q1=q1, median=med, mean=x.mean(), q3=q3,
                maximum=whishi, lower=lower, upper=upper)


def make(spark, arr, dep):
    return spark.createDataFrame(list(zip(arr, dep)), "ARR_DELAY double, DEP_DELAY double")


def check(spark, arr, dep):
    df = make(spark, arr, dep)
    summary = {r["delay"]: r.asDict() for r in D.box_summary(df).collect()}
    outliers = rows(D.delay_outliers(df))
    hist = rows(D.outlier_histogram(df))
    for name, col in (("ARR_DELAY", arr), ("DEP_DELAY", dep)):
        want = brute_box(col)
        got = summary[name]
        for key in ("count", "minimum", "q1", "median", "q3", "maximum"):
            assert got[key] == pytest.approx(want[key], abs=1e-9), (name, key)
        assert got["mean"] == pytest.approx(want["mean"], rel=1e-12)
        assert got["lower_outliers"] == len(want["lower"])
        assert got["upper_outliers"] == len(want["upper"])
        assert sorted(v for d, s, v in outliers if d == name and s == "lower") == want["lower"]
        assert sorted(v for d, s, v in outliers if d == name and s == "upper") == want["upper"]
        counts, edges = np.histogram(want["upper"], bins=10)
        mine = sorted((b, s, e, c) for d, b, s, e, c in hist if d == name)
        assert [c for _, _, _, c in mine] == counts.tolist(), name
        assert [s for _, s, _, _ in mine] == pytest.approx(edges[:-1].tolist())
        assert [e for _, _, e, _ in mine] == pytest.approx(edges[1:].tolist())


def test_random_heavy_tail_with_nulls(spark):
    rng = np.random.default_rng(7)
    n = 3000
    arr = np.round(rng.normal(5, 20, n) + (rng.random(n) < 0.05) * rng.integers(50, 900, n)).tolist()
    dep = np.round(rng.normal(0, 10, n) - (rng.random(n) < 0.02) * rng.integers(50, 200, n)).tolist()
    arr[::97] = [None] * len(arr[::97])
    check(spark, arr, dep)


def test_values_on_bin_edges(spark):
    # Upper outliers 100..200: edges fall on whole numbers, values sit on them.
    base = [0.0] * 40 + [1.0] * 40
    arr = base + [float(v) for v in range(100, 201, 10)]
    check(spark, arr, list(reversed(arr)))


def test_all_upper_outliers_equal(spark):
    arr = [0.0, 1.0, 2.0, 3.0] * 10 + [500.0, 500.0, 500.0]
    check(spark, arr, arr)


def test_no_outliers_at_all(spark):
    arr = [float(v) for v in range(20)]
    check(spark, arr, arr)
    hist = rows(D.outlier_histogram(make(spark, arr, arr)))
    assert sum(c for *_, c in hist) == 0 and len(hist) == 20


def test_constant_column(spark):
    check(spark, [3.0] * 9, [3.0] * 8 + [4.0])


def test_histogram_stays_distributed(spark):
    """The outlier rows are never gathered: the plan groups the histogram
    by (delay, value) with a partial aggregate before any shuffle."""
    df = make(spark, [1.0, 2.0], [3.0, 4.0])
    plan = D.box_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan or "partial_percentile" in plan


def test_delay_reports_share_one_histogram(spark):
    rng = np.random.default_rng(3)
    arr = np.round(rng.normal(0, 15, 800) + (rng.random(800) < 0.05) * 300).tolist()
    dep = np.round(rng.normal(2, 9, 800)).tolist()
    df = make(spark, arr, dep)
    together = D.delay_reports(df)
    assert sorted(rows(together["delay_box_summary"])) == sorted(rows(D.box_summary(df)))
    assert sorted(rows(together["delay_outliers"])) == sorted(rows(D.delay_outliers(df)))
    assert rows(together["outlier_histogram"]) == rows(D.outlier_histogram(df))


def test_approximate_quartiles_for_continuous_values(spark):
    rng = np.random.default_rng(5)
    arr = (rng.normal(0, 30, 5000) + (rng.random(5000) < 0.03) * 400).tolist()
    dep = rng.exponential(20, 5000).tolist()
    df = make(spark, arr, dep)
    got = {r["delay"]: r for r in D.box_summary(df, accuracy=100000).collect()}
    for name, col in (("ARR_DELAY", arr), ("DEP_DELAY", dep)):
        want = brute_box(col)
        spread = want["q3"] - want["q1"]
        for key in ("q1", "median", "q3"):
            assert abs(got[name][key] - want[key]) <= 0.01 * spread, (name, key)
        assert got[name]["count"] == want["count"]
        assert got[name]["mean"] == pytest.approx(want["mean"], rel=1e-9)
    out = D.delay_outliers(df, accuracy=100000).count()
    assert abs(out - sum(len(brute_box(c)["lower"]) + len(brute_box(c)["upper"]) for c in (arr, dep))) <= 10


def test_quartiles_are_the_same_on_any_number_of_partitions(spark):
    from aerolens.plans.catalog import queries

    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            flown = queries()["flown_flights"](spark, "/root/testdata/sf0.001").repartition(n)
            found.append([sorted(rows(f(flown))) for f in (D.box_summary, D.delay_outliers, D.outlier_histogram)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_quartiles_of_continuous_hot_and_extreme_values(spark):
    rng = np.random.default_rng(9)
    arr = (rng.normal(0, 30, 4000) + (rng.random(4000) < 0.03) * 400).tolist()
    arr += [1e300, -1e300, 1e-300, -0.0, 0.0]
    dep = [0.0] * 2000 + rng.exponential(20, 2005).tolist()  # a hot value: half the rows
    check_box(spark, arr, dep)
    check_box(spark, [1.0 + k * 1e-12 for k in range(500)], [2.0**k for k in range(-250, 250)])  # one range; many
    check_box(spark, [-5.0], [7.0])
    check_box(spark, [-5.0, 3.5], [7.0, 7.0])


def check_box(spark, arr, dep):
    got = {r["delay"]: r for r in D.box_summary(make(spark, arr, dep)).collect()}
    for name, col in (("ARR_DELAY", arr), ("DEP_DELAY", dep)):
        want = brute_box(col)
        for key in ("count", "q1", "median", "q3", "minimum", "maximum"):
            assert got[name][key] == pytest.approx(want[key], rel=1e-12, abs=1e-12), (name, key)
        assert got[name]["upper_outliers"] == len(want["upper"])


def test_ranges_keep_the_order_of_values(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(0, 1e3, 2000), rng.normal(0, 1e-6, 500), np.arange(-1500, 1500), [1e308, -1e308, float("inf"), -float("inf")]])
    values = np.sort(np.concatenate([values, np.nextafter(values, np.inf)])).tolist()
    df = spark.createDataFrame([(float(v),) for v in values] + [(float("nan"),)], "value double")
    found = [r[1] for r in sorted(df.select("value", D.value_range(F.col("value"))).collect(), key=lambda r: (r[0] != r[0], r[0]))]
    assert found == sorted(found)
    whole = [r[0] for r in spark.range(-900, 900).select(D.value_range(F.col("id").cast("double"))).collect()]
    assert len(set(whole)) == 1800
