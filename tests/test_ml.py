import pytest
from pyspark.sql import functions as F

from aerolens.operators import ml
from aerolens.plans.modeling import feature_vectors, perceptron_scores, prepared_parts, stratified_split_counts
from aerolens.plans import tables
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def model_rows(spark):
    return tables.model_rows(tables.enriched_flights(spark, SF_SMALL)).cache()


def test_tag_split_partitions_rows(spark, model_rows):
    tagged = ml.tag_split(model_rows, 0.8, seed=3)
    train, test = ml.parts(tagged)
    n = model_rows.count()
    assert train.count() + test.count() == n
    assert 0.75 < train.count() / n < 0.85
    first, second, third = ml.split_data(model_rows, (0.5, 0.25, 0.25), seed=3)
    assert first.count() + second.count() + third.count() == n
    assert 0.45 < first.count() / n < 0.55 and 0.2 < third.count() / n < 0.3


def test_split_does_not_depend_on_the_layout(spark, model_rows):
    found = []
    for n in (1, 3, 8):
        train = ml.tag_split(model_rows.repartition(n), 0.7, seed=42).filter("part = 'train'")
        found.append(sorted(map(str, train.collect())))
    assert found[0] == found[1] == found[2]
    other = ml.tag_split(model_rows, 0.7, seed=43).filter("part = 'train'")
    assert sorted(map(str, other.collect())) != found[0]


def draws(df):
    """The lines of the optimized plan that take the hash which draws a row's part."""
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "md5(" in line]


def test_a_lot_is_drawn_once_a_row(spark):
    rows = tables.model_rows(tables.enriched_flights(spark, SF_SMALL))
    for lot in ml.split_data(rows, (0.5, 0.3, 0.2), seed=7):
        (line,) = draws(lot.groupBy("Year").count())
        assert line.count("md5(") == 1 and "Filter" not in line


def test_a_tagged_part_is_drawn_once_a_row(spark):
    rows = tables.model_rows(tables.enriched_flights(spark, SF_SMALL))
    for part in ml.parts(ml.tag_split(rows, 0.7)):
        (line,) = draws(part.groupBy("Year").count())
        assert line.count("md5(") == 1 and "Filter" not in line


def test_stratified_counts_cover_every_year(spark, model_rows):
    counts = stratified_split_counts(model_rows).collect()
    years = {r.Year for r in model_rows.select("Year").distinct().collect()}
    assert {r.Year for r in counts} == years
    assert sum(r.Number for r in counts) == model_rows.count()


def test_feature_pipeline_fitted_on_train(spark, model_rows):
    train, test = ml.split_data(model_rows, (0.7, 0.3), seed=5)
    model, train_f, test_f = ml.prepare(train, test)
    width = ml.feature_width(train_f)
    levels = [train.select(c).distinct().count() for c in ml.CATEGORY_COLUMNS]
    assert width == sum(levels) + len(ml.NUMERIC_COLUMNS)
    assert train_f.columns == train.columns + [c + "_Index" for c in ml.CATEGORY_COLUMNS] + [ml.FEATURES, ml.LABEL]
    # Indexer: most frequent label gets index 0.
    top_label = train.groupBy("Labels").count().orderBy(F.desc("count")).first()["Labels"]
    assert train_f.filter(F.col("Labels") == top_label).select(ml.LABEL).distinct().collect()[0][0] == 0.0
    # Only rows with a null number are skipped, and counted.
    assert test_f.count() == test.count() - ml.unusable(test).first()["skipped"]


def test_unseen_categories_are_kept(spark, model_rows):
    odd = model_rows.limit(3).withColumn("OP_CARRIER", F.lit("unseen")).withColumn("ORIGIN", F.lit(None).cast("string"))
    odd = odd.union(odd.limit(1).withColumn("TAXI_IN", F.lit(None).cast("double")))
    model, train_f, odd_f = ml.prepare(model_rows, odd)
    assert odd_f.count() == 3 and ml.unusable(odd).first()["skipped"] == 1
    levels = model_rows.select("OP_CARRIER").distinct().count()
    assert {r[0] for r in odd_f.select("OP_CARRIER_Index").collect()} == {float(levels)}


def test_indexers_from_one_aggregate_equal_fitted_ones(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame(
        [("b", "x", "1"), ("a", "x", "2"), ("a", None, "10"), ("b", "y", "2"), (None, "z", "é"), ("c", "", "1")],
        "p string, q string, r string",
    )
    fitted = StringIndexer(inputCols=["p", "q", "r"], outputCols=["i", "j", "k"], handleInvalid="keep").fit(df)
    mine = ml.labels_by_frequency(df, ["p", "q", "r"])
    assert [mine[c] for c in "pqr"] == [list(x) for x in fitted.labelsArray]


def test_encoders_are_fitted_in_one_scan(spark, model_rows):
    """Fitting runs the aggregate and nothing else over the training rows."""
    tracker, group = spark.sparkContext.statusTracker(), "fit-encoders"
    spark.sparkContext.setJobGroup(group, group)
    try:
        ml.feature_pipeline(model_rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) <= 2  # the aggregate, in one or two adaptive steps


def test_vector_summary_adds_up(spark, model_rows):
    train_f, _ = prepared_parts(model_rows)
    rows = {r["feature"]: r for r in ml.vector_summary(train_f).collect()}
    assert len(rows) == ml.feature_width(train_f)
    vectors = [r[0] for r in train_f.select(ml.FEATURES).collect()]
    names = ml.feature_names(train_f)
    for place in (0, 1, len(names) // 2, len(names) - 1):
        values = [float(v[place]) for v in vectors]
        got = rows[names[place]]
        assert (got["vectors"], got["total"], got["nonzero"]) == (len(values), sum(values), sum(x != 0 for x in values))
    carriers = [r for n, r in rows.items() if n.startswith("OP_CARRIER_OneHot_")]
    assert sum(r["nonzero"] for r in carriers) == len(vectors)


def test_fits_are_the_same_from_any_layout(spark, model_rows):
    found = []
    for n in (1, 3, 8):
        train_f, test_f = prepared_parts(model_rows.repartition(n), seed=11, partitions=4)
        assert train_f.rdd.getNumPartitions() == 4
        models = dict(ml.default_models(), perceptron=ml.perceptron(ml.feature_width(train_f), (8, 4), max_iter=4))
        found.append([(r["algorithm"], r["f1"], r["accuracy"]) for r in ml.compare_models(train_f, test_f, models).collect()])
    assert found[0] == found[1] == found[2] and len(found[0]) == 5


def test_more_rows_are_fitted_on_more_partitions(spark, model_rows, monkeypatch):
    """A partition to fit on holds a bounded number of rows, from any input layout."""
    monkeypatch.setattr(ml, "FIT_ROWS", 500, raising=False)
    n = model_rows.count()
    for layout in (1, 5):
        train_f, test_f = prepared_parts(model_rows.repartition(layout), partitions=4)
        assert train_f.rdd.getNumPartitions() == test_f.rdd.getNumPartitions() == -(-n // 500) > 4


def test_the_perceptron_is_fitted_on_bounded_partitions(spark, model_rows, monkeypatch):
    """Its dense rows stay whole in memory during a fit, so a partition's are bounded."""
    found = []

    def compared(train, test, models):
        found.append((train.rdd.getNumPartitions(), test.rdd.getNumPartitions(), *models))
        return spark.createDataFrame([], ml.COMPARISON_SCHEMA)

    monkeypatch.setattr(ml, "FIT_ROWS", 500, raising=False)
    monkeypatch.setattr(ml, "compare_models", compared)
    perceptron_scores(model_rows, partitions=4)
    wanted = -(-model_rows.count() // 500)
    assert found == [(wanted, wanted, "Multilayer Perceptron")] and wanted > 4


@pytest.mark.parametrize("partitions, block_size", [(2, 128), (20, 7)])
def test_the_perceptron_is_fitted_as_by_spark(spark, model_rows, partitions, block_size):
    """The same weights but for rounding, from sparse and dense vectors, few and many
    partitions, partial blocks and a partition without rows; no summary of another fit."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors

    flights = prepared_parts(model_rows, seed=11, partitions=partitions)[0].select(ml.FEATURES, ml.LABEL)
    few = [(Vectors.dense([i % 3 - 1.0, i % 5 / 4, 0.5]), float(i * i % 3)) for i in range(60)]
    few += [(Vectors.sparse(3, {1: i / 4.0}), float(i % 3)) for i in range(20)]
    small = spark.createDataFrame(few, [ml.FEATURES, ml.LABEL]).coalesce(1).repartitionByRange(partitions, ml.LABEL)
    for train, width in ((flights, ml.feature_width(flights)), (small, 3)):
        train = train.persist()
        mine = ml.perceptron(width, (5, 4), max_iter=6, block_size=block_size)
        spark_own = MultilayerPerceptronClassifier(**{p.name: v for p, v in mine.extractParamMap().items()})
        got, wanted = mine.fit(train), spark_own.fit(train)
        assert got.weights.toArray() == pytest.approx(wanted.weights.toArray(), rel=1e-5, abs=1e-6)
        assert type(got) is type(wanted) and got.getMaxIter() == 6 and not got.hasSummary
        train.unpersist()


def test_rows_to_fit_stay_sparse(spark, model_rows):
    """A pass of the perceptron reads values and places, not a width of zeros."""
    from aerolens.operators import perceptron

    train_f, _ = prepared_parts(model_rows, partitions=2)
    layers = [ml.feature_width(train_f), 4, 3]
    packed = perceptron._packed(train_f, ml.FEATURES, ml.LABEL, layers, 128)
    read = sum(len(value) for row in packed.collect() for value in row)
    assert read < train_f.count() * layers[0] * 8 / 10


def test_a_label_outside_the_classes_is_an_error(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense([1.0]), 3.0)], [ml.FEATURES, ml.LABEL])
    with pytest.raises(Exception, match="isn't one of 3 classes"):
        ml.perceptron(1, (2,)).fit(rows)


def test_rows_are_predicted_once_for_the_scores(spark):
    seen = spark.sparkContext.accumulator(0)

    def guess(label):
        seen.add(1)
        return label

    rows = spark.range(50).select((F.col("id") % 3).cast("double").alias(ml.LABEL))
    predicted = rows.withColumn(ml.PREDICTION, F.udf(guess, "double")(ml.LABEL))
    assert ml.evaluate(predicted) == {"f1": 1.0, "accuracy": 1.0} and seen.value == 50


def test_parts_are_shuffled_apart(spark, model_rows):
    """Each part is laid out alone, after its rows were picked: no row is shuffled twice."""
    for part in prepared_parts(model_rows, partitions=3):
        plan = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
        dealt = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
        picked = [i for i, line in enumerate(plan) if "Filter" in line and "(part#" in line]
        assert picked and min(picked) > dealt


def test_feature_vectors_query(spark, model_rows):
    out = feature_vectors(model_rows)
    assert set(out.columns) >= {"OP_CARRIER_Index", ml.LABEL, "part"}
    assert out.count() == model_rows.count()


def test_classifiers_beat_majority_class(spark, model_rows):
    train_f, test_f = prepared_parts(model_rows, seed=11)
    majority = test_f.groupBy(ml.LABEL).count().orderBy(F.desc("count")).first()["count"] / test_f.count()
    models = ml.default_models()
    table = {r.algorithm: r for r in ml.compare_models(train_f, test_f, models).collect()}
    assert set(table) == set(models) and len(table) == 4
    for r in table.values():
        assert r.accuracy > majority and 0 < r.f1 <= 1 and r.seconds > 0


def test_models_are_compared_in_a_session_that_observed_a_frame(spark, model_rows):
    """Fitted models must not take the session along: it holds what observes frames."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    train_f, test_f = prepared_parts(model_rows, seed=11, partitions=2)
    models = {"lr": ml.logistic_one_vs_rest(max_iter=2), "svm": ml.svm_one_vs_rest(max_iter=2)}
    assert [r.algorithm for r in ml.compare_models(train_f, test_f, models).collect()] == ["lr", "svm"]


def test_perceptron_reads_input_width(spark, model_rows):
    train_f, test_f = prepared_parts(model_rows, seed=11)
    width = ml.feature_width(train_f)
    est = ml.perceptron(width, hidden=(8,), max_iter=5)
    assert est.getLayers()[0] == width
    fitted = est.fit(train_f)
    assert set(ml.evaluate(fitted.transform(test_f))) == {"f1", "accuracy"}


def test_default_model_settings():
    models = ml.default_models()
    assert models["Decision Tree"].getMaxDepth() == 3
    rf = models["Random Forest"]
    assert rf.getNumTrees() == 20 and rf.getMaxDepth() == 5
    lr = models["Logistic Regression (one-vs-rest)"].getClassifier()
    assert lr.getMaxIter() == 10
    svc = models["Linear SVM (one-vs-rest)"].getClassifier()
    assert svc.getMaxIter() == 10 and svc.getRegParam() == 0.1


def test_evaluate_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    pred = spark.createDataFrame(
        [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 7 + [(1.0, 1.0)] * 20 + [(1.0, 2.0)] * 9
        + [(2.0, 0.0)] * 11 + [(2.0, 2.0)] * 3 + [(1.0, 0.0)] * 4,
        "label_index double, prediction double",
    )
    mine = ml.evaluate(pred)
    for metric in ("f1", "accuracy"):
        ev = MulticlassClassificationEvaluator(
            labelCol="label_index", predictionCol="prediction", metricName=metric
        )
        assert mine[metric] == pytest.approx(ev.evaluate(pred), rel=1e-12)
    never_predicted = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "label_index double, prediction double")
    ev = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol="prediction")
    assert ml.evaluate(never_predicted)["f1"] == pytest.approx(ev.evaluate(never_predicted), rel=1e-12)
