import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from aerolens.operators import ml, trees
from aerolens.plans import tables
from aerolens.plans.modeling import prepared_parts
from conftest import SF_SMALL

COLUMNS = {"featuresCol": ml.FEATURES, "labelCol": ml.LABEL}


@pytest.fixture(scope="module")
def train(spark):
    rows = tables.model_rows(tables.enriched_flights(spark, SF_SMALL))
    return prepared_parts(rows, seed=11, partitions=3)[0].select(ml.FEATURES, ml.LABEL).cache()


def spark_own(estimator):
    kind = RandomForestClassifier if isinstance(estimator, RandomForestClassifier) else DecisionTreeClassifier
    return kind(**{p.name: v for p, v in estimator.extractParamMap().items()})


def shape(model):
    """All splits and predictions, without the model's name."""
    return model.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("times", [1, 4])
def test_trees_are_those_of_spark(spark, train, times):
    """The same splits and leaves, with candidates from all rows and from a sample; a
    forest's too, features drawn for each node included, if no rows are drawn."""
    rows = train.crossJoin(spark.range(times)).drop("id").coalesce(2).persist()
    assert (rows.count() > trees.SPLIT_ROWS) == (times > 1)
    for mine in (
        ml.decision_tree(),
        trees.SparseDecisionTree(**COLUMNS, maxDepth=7, minInstancesPerNode=20, minInfoGain=0.001, maxBins=12),
        trees.SparseRandomForest(**COLUMNS, seed=3, bootstrap=False, numTrees=6),
        trees.SparseRandomForest(**COLUMNS, seed=4, bootstrap=False, numTrees=3, featureSubsetStrategy="all", maxDepth=4),
    ):
        got, wanted = mine.fit(rows), spark_own(mine).fit(rows)
        assert type(got) is type(wanted) and shape(got) == shape(wanted)
        assert got.featureImportances == wanted.featureImportances
        first, second = (
            m.transform(rows).select("rawPrediction", "probability", "prediction").collect() for m in (got, wanted)
        )
        assert first == second
    rows.unpersist()


def test_the_registered_trees_are_fitted_over_sparse_rows(spark, train):
    """A pass reads the bins of the values that a row holds, not one for each place."""
    for name in ("Decision Tree", "Random Forest"):
        estimator = ml.default_models()[name]
        assert isinstance(estimator, trees.SparseDecisionTree | trees.SparseRandomForest)
        bins = trees._bins(estimator, train, 1, "all")
        packed = trees._packed(train, ml.FEATURES, ml.LABEL, bins).collect()
        read = sum(len(row[c]) for row in packed for c in ("labels", "lengths", "cells"))
        assert read < train.count() * ml.feature_width(train) * 4 / 10
        assert bins.rows == train.count() and len(packed) == 3


def test_a_forest_draws_as_many_rows_as_spark(spark, train):
    """Poisson counts, others for each tree, as many as in Spark's forest; the same in each fit."""
    rng = np.random.Generator(np.random.SFC64(5))
    for rate in (0.3, 1.0, 4.0):
        drawn = trees.Poisson(rate).draw(rng, (20, 50_000)).astype(int)
        assert drawn.mean() == pytest.approx(rate, rel=0.01) and drawn.var() == pytest.approx(rate, rel=0.02)
        assert (drawn == 0).mean() == pytest.approx(np.exp(-rate), rel=0.02)
    mine = ml.random_forest()
    got, again, wanted = mine.fit(train), ml.random_forest().fit(train), spark_own(mine).fit(train)
    assert shape(got) == shape(again)
    n = train.count()
    for model in (got, wanted):
        rows = [tree._call_java("rootNode").impurityStats().rawCount() for tree in model.trees]
        assert len(set(rows)) > 10 and np.mean(rows) == pytest.approx(n, rel=0.02)
        assert 0.4 < np.std(rows) / np.sqrt(n) < 1.8
    assert ml.evaluate(got.transform(train))["accuracy"] > 0.45


def test_many_partial_counts_are_merged_and_none_is_lost(spark, train):
    """The same tree from many partitions, some of them empty, and nodes counted one at a time."""
    wanted = shape(ml.decision_tree().fit(train))
    many = train.repartition(trees.DIRECT_SUMS + 14).persist()
    assert shape(ml.decision_tree().fit(many)) == wanted
    assert shape(ml.decision_tree().fit(train.coalesce(1).repartitionByRange(5, ml.LABEL))) == wanted
    assert shape(ml.decision_tree().setMaxMemoryInMB(0).fit(train)) == wanted


def test_what_is_not_covered_is_left_to_spark(spark, train):
    plain = spark.createDataFrame(
        [(Vectors.dense([i % 7, i % 3]), float(i % 2), 1.0 + i % 4) for i in range(60)], [ml.FEATURES, ml.LABEL, "w"]
    )
    weighed = train.withColumn("w", F.lit(2.0))
    for rows, settings in ((plain, {}), (weighed, {"weightCol": "w"}), (train, {"impurity": "entropy"})):
        mine = trees.SparseDecisionTree(**COLUMNS, **settings)
        assert trees._bins(mine, rows, 1, "all") is None
        assert shape(mine.fit(rows)) == shape(spark_own(mine).fit(rows))


def test_rows_that_cannot_be_fitted_are_an_error(spark, train):
    meta = {c: train.schema[c].metadata for c in (ml.FEATURES, ml.LABEL)}
    width = ml.feature_width(train)
    bad = [
        (Vectors.sparse(width, {width - 1: 1.0}), 7.0, "isn't one of 3 classes"),
        (Vectors.sparse(width, {width - 1: float("nan")}), 1.0, "NaN or infinity"),
        (Vectors.sparse(width, {0: 3.0}), 1.0, "neither 0 nor 1"),
    ]
    for vector, label, message in bad:
        rows = spark.createDataFrame([(vector, label)] * 3, [ml.FEATURES, ml.LABEL])
        rows = rows.select(*(F.col(c).alias(c, metadata=meta[c]) for c in rows.columns))
        with pytest.raises(Exception, match=message):
            ml.decision_tree().fit(rows)


def test_a_fit_is_the_same_in_any_number_of_tasks(spark, train, monkeypatch):
    """Partitions counted one after another in a task give the same draws and sums, to the
    last bit, and no partition starts a task of its own in each pass."""
    from aerolens.operators import linear

    many, found = train.repartition(40).persist(), []
    logistic = linear.SparseOneVsRest(classifier=ml.logistic_one_vs_rest(max_iter=3).getClassifier(), **COLUMNS)
    for tasks in (1, 100):
        monkeypatch.setattr(trees, "TASKS", tasks)
        forest = trees.SparseRandomForest(**COLUMNS, seed=1, numTrees=3, maxDepth=3).fit(many)
        found.append((shape(forest), [list(m.coefficients.toArray()) for m in logistic.fit(many).models]))
    assert found[0] == found[1]
    monkeypatch.undo()
    wide = train.repartition(500)
    most = trees.TASKS * spark.sparkContext.defaultParallelism
    assert trees.in_few_tasks(wide).rdd.getNumPartitions() == most < 500
    many.unpersist()
