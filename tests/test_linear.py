import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from aerolens.operators import linear, ml
from aerolens.plans import tables
from aerolens.plans.modeling import prepared_parts
from conftest import SF_SMALL

COLUMNS = {"featuresCol": ml.FEATURES, "labelCol": ml.LABEL}


@pytest.fixture(scope="module")
def train(spark):
    rows = tables.model_rows(tables.enriched_flights(spark, SF_SMALL))
    return prepared_parts(rows, seed=11, partitions=3)[0].select(ml.FEATURES, ml.LABEL).cache()


@pytest.fixture(scope="module")
def mixed(spark):
    """Dense and sparse vectors: a constant place, one that is never used, halves and negative numbers."""
    rows = [(Vectors.dense([i % 7 - 3.0, 5.0, (i % 4) / 2, 0.0]), float(i % 3)) for i in range(60)]
    rows += [(Vectors.sparse(4, {0: i % 5 / 4, 1: 5.0}), float(i * i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, [ml.FEATURES, ml.LABEL]).repartition(3)
    return df.select(F.col(ml.FEATURES).alias(ml.FEATURES, metadata={"ml_attr": {"num_attrs": 4}}), ml.LABEL).cache()


def same(got, wanted, rows):
    assert type(got) is type(wanted) and len(got.models) == len(wanted.models)
    for mine, theirs in zip(got.models, wanted.models):
        assert type(mine) is type(theirs) and mine.getLabelCol() == theirs.getLabelCol()
        assert mine.coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), rel=1e-6, abs=1e-9)
        assert mine.intercept == pytest.approx(theirs.intercept, rel=1e-6, abs=1e-9)
    first, second = (ml.without_summary(m).transform(rows).select(ml.PREDICTION).collect() for m in (got, wanted))
    assert first == second


@pytest.mark.parametrize("direct", [0, linear.DIRECT_BYTES])
def test_one_vs_rest_is_fitted_as_by_spark(spark, train, mixed, monkeypatch, direct):
    """The same weights but for rounding, with partial sums brought together in one step or two."""
    monkeypatch.setattr(linear, "DIRECT_BYTES", direct)
    for rows, classifier in (
        (train, LogisticRegression(maxIter=10)),
        (train, LinearSVC(maxIter=10, regParam=0.1)),
        (mixed, LogisticRegression(maxIter=20, regParam=0.05)),
        (mixed, LinearSVC(maxIter=30)),
    ):
        mine = linear.SparseOneVsRest(classifier=classifier, **COLUMNS)
        same(mine.fit(rows), OneVsRest(classifier=classifier, **COLUMNS).fit(rows), rows)


def test_the_registered_models_share_their_passes(spark, train, monkeypatch):
    """Rows are packed once for all classes, and a pass answers all that still run."""
    asked, packed = [], []
    sums, pack = linear.Together._sums, linear._packed
    monkeypatch.setattr(linear.Together, "_sums", lambda self, a: (asked.append([k for k, _ in a]), sums(self, a))[1])
    monkeypatch.setattr(linear, "_packed", lambda *a: (packed.append(1), pack(*a))[1])
    for name in ("Logistic Regression (one-vs-rest)", "Linear SVM (one-vs-rest)"):
        asked.clear(), packed.clear()
        estimator = ml.default_models()[name]
        assert estimator.getParallelism() == ml.OVR_PARALLELISM
        estimator.fit(train)
        assert len(packed) == 1 and asked[0] == [0, 1, 2]
        evaluations = sum(map(len, asked))
        assert len(asked) < evaluations / 2


def test_packed_rows_are_small_and_exact(spark, train):
    width = ml.feature_width(train)
    blocks = linear._packed(train, ml.FEATURES, ml.LABEL, width).collect()
    assert sum(len(b[c]) for b in blocks for c in linear.FIELDS) < train.count() * 40
    rows = train.collect()
    at = 0
    for block in map(linear._unpacked, (b.asDict() for b in blocks)):
        n = len(block.labels)
        dense = [[0.0] * width for _ in range(n)]
        for f, column in zip(block.full, block.table):
            for i, v in enumerate(column):
                dense[i][f] = v
        for own, places, values in block.slots:
            index = range(n) if isinstance(own, slice) else own
            for j, i in enumerate(index):
                dense[i][block.used[places[j]]] = 1.0 if values is None else values[j]
        for i in range(n):
            assert dense[i] == list(rows[at + i][ml.FEATURES].toArray()) and block.labels[i] == rows[at + i][ml.LABEL]
        at += n
    assert at == len(rows)


def test_numbers_are_kept_exactly():
    import numpy as np

    for values in ([1, -128], [300, -2.0], [0.5, 70000.0], [0.1, 1e300], []):
        data = linear._small(np.array(values, float), linear.NUMBERS)
        assert list(linear._read(data.tobytes(), len(values), linear.NUMBERS)) == values


def test_what_is_not_covered_is_left_to_spark(spark, train, mixed):
    weighed = mixed.withColumn("w", F.rand(3) + 0.5).cache()
    two = mixed.filter(F.col(ml.LABEL) != 1.0).cache()  # a class without rows
    for rows, classifier, settings in (
        (weighed, LogisticRegression(maxIter=5), {"weightCol": "w"}),
        (mixed, LogisticRegression(maxIter=5, fitIntercept=False), {}),
        (mixed, LogisticRegression(maxIter=5, regParam=0.1, elasticNetParam=0.5), {}),
        (mixed, LinearSVC(maxIter=5, standardization=False), {}),
        (two, LogisticRegression(maxIter=5), {}),
    ):
        mine = linear.SparseOneVsRest(classifier=classifier, **COLUMNS, **settings)
        same(mine.fit(rows), OneVsRest(classifier=classifier, **COLUMNS, **settings).fit(rows), rows)


def test_rows_that_cannot_be_fitted_are_an_error(spark, mixed):
    meta = mixed.schema[ml.FEATURES].metadata
    for vector, label, message in (
        (Vectors.dense([1.0, 2.0, 3.0, float("nan")]), 1.0, "NaN or infinity"),
        (Vectors.dense([1.0, 2.0, 3.0, 4.0]), 0.5, "isn't the number of a class"),
    ):
        bad = spark.createDataFrame([(vector, label)], [ml.FEATURES, ml.LABEL])
        bad = bad.select(F.col(ml.FEATURES).alias(ml.FEATURES, metadata=meta), ml.LABEL).union(mixed)
        with pytest.raises(Exception, match=message):
            ml.logistic_one_vs_rest(max_iter=2).fit(bad)
