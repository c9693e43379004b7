"""Train/test splits, feature preparation and classifiers.

Category indexing and encoding are distributed aggregates, and every classifier
trains from partition-level statistics: Spark ML's estimators, whose fits run over
packed sparse rows (``trees``, ``linear``, ``perceptron``) and give Spark's models.
The driver only loops over the (few) models.

Differences from a naive script, on purpose:
- every split is seeded and a function of the row's key, so it is the same on
  any cluster and needs no materialised copy;
- encoders are fitted on the training part only, so the test part cannot
  leak categories into the encoding;
- all indexers come from one aggregate instead of a job for each column;
- models are fitted on a layout of their own, a given number of partitions with
  rows dealt and sorted by their values, whatever the input's partitions;
- vectors and labels are materialised once before the models are timed;
- f1 and accuracy are reported under their own names, both from one
  confusion-matrix aggregate per model.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolens.operators.linear import SparseOneVsRest
from aerolens.operators.perceptron import SparsePerceptron
from aerolens.operators.trees import SparseDecisionTree, SparseRandomForest

# Model inputs and column names.
CATEGORY_COLUMNS = ["OP_CARRIER", "ORIGIN", "DEST"]
NUMERIC_COLUMNS = ["TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "DEP_TIME", "DEP_DELAY"]
LABEL_SOURCE = "Labels"
LABEL = "label_index"
FEATURES = "features"
PREDICTION = "prediction"


# What tells a row apart for the split, as text.
SPLIT_KEY = ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME"]


def _draw(key: Sequence[str], seed: int) -> Column:
    """Eight hex digits of a hash of the seed and the row's key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.substring(F.md5(text), 1, 8)


def _threshold(share: float) -> Column:
    return F.lit(format(min(round(share * 16**8), 16**8 - 1), "08x"))


def _drawn(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row. A filter on a plain column is
    pushed below the joins with all that the hash is made of written out at each
    mention, a method too large for the JIT compiler; one on an exploded column isn't."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def split_data(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, key: Sequence[str] = SPLIT_KEY
) -> list[DataFrame]:
    """M1 (and M8 with weights 0.7/0.3): seeded split into parts of about
    these shares, each a plain filter. A row's part depends on its key alone,
    not on the layout; rows of equal key go together."""
    total, edges, at = sum(weights), [], 0.0
    for w in weights[:-1]:
        at += w / total
        edges.append(_threshold(at))
    drawn, draw, out = _drawn(df, "_draw", _draw(key, seed)), F.col("_draw"), []
    for low, high in zip([None, *edges], [*edges, None]):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (draw >= low)
        if high is not None:
            inside = inside & (draw < high)
        out.append(drawn.filter(inside).drop("_draw"))
    return out


def tag_split(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42, key: Sequence[str] = SPLIT_KEY
) -> DataFrame:
    """M2 (and M8 with 0.7): add ``part`` = 'train' or 'test'.

    Every row is placed by a hash of its own key, so each year is split in
    about the same proportion as the whole, without one split per year and a
    union of the parts, and without materialising anything: any pass over the
    rows, on any number of partitions, gives the same parts.
    """
    part = F.when(_draw(key, seed) < _threshold(train_fraction), F.lit("train")).otherwise(F.lit("test"))
    return _drawn(df, "part", part)


def parts(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test frames of a ``tag_split`` result."""
    return (
        tagged.filter(F.col("part") == "train").drop("part"),
        tagged.filter(F.col("part") == "test").drop("part"),
    )


def labels_by_frequency(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The distinct values of each column, most frequent first, equally frequent
    ones by name, without null: what a string indexer fits, for all columns
    from one GROUPING SETS aggregate and so from one scan. The driver gets
    the categories, as an indexer's fit does."""
    columns = list(columns)
    text = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    counts = text.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id(*columns).alias("_set"), F.count(F.lit(1)).alias("_n")
    )
    own = {(1 << len(columns)) - 1 - (1 << (len(columns) - 1 - k)): c for k, c in enumerate(columns)}
    out: dict[str, list] = {c: [] for c in columns}
    for row in counts.collect():
        column = own[row["_set"]]
        if row[column] is not None:
            out[column].append((-row["_n"], row[column]))
    return {c: [value for _, value in sorted(found)] for c, found in out.items()}


def feature_pipeline(
    train: DataFrame,
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
) -> PipelineModel:
    """M3-M7: index categories (most frequent = 0; null or unseen values get an
    index of their own, so no row is lost to them), index the label, one-hot
    encode (that last index is the dropped level), assemble with the numeric
    columns (a row with a null number has no vector and is skipped; see
    ``unusable``). All indexers come from one pass over ``train``; the encoder
    takes its widths from their metadata and reads no rows."""
    # The suffixes of the encoded columns.
    index_out = [c + "_Index" for c in categories]
    onehot_out = [c + "_OneHot" for c in categories]
    labels = labels_by_frequency(train, [*categories, LABEL_SOURCE])
    # One model a column: the array form fills shorter label lists up with nulls.
    indexers = [
        StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=out, handleInvalid="keep")
        for c, out in zip(categories, index_out, strict=True)
    ]
    return Pipeline(stages=[
        *indexers,
        StringIndexerModel.from_labels(labels[LABEL_SOURCE], inputCol=LABEL_SOURCE, outputCol=LABEL),
        OneHotEncoder(inputCols=index_out, outputCols=onehot_out, handleInvalid="error"),
        VectorAssembler(inputCols=onehot_out + list(numerics), outputCol=FEATURES, handleInvalid="skip"),
    ]).fit(train.limit(0))  # nothing left to learn but the columns


def unusable(df: DataFrame, numerics: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """One row: how many rows the assembler skips for a null number."""
    lost = reduce(or_, [F.col(c).isNull() for c in numerics])
    return df.select(F.count(F.when(lost, F.lit(1))).alias("skipped"))


def prepare_tagged(tagged: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """M7 over a ``tag_split`` result: fit the feature pipeline on its train part
    and transform all rows at once. Keeps the original columns with ``part``, the
    category indices, ``features`` and ``label_index``."""
    model = feature_pipeline(parts(tagged)[0])
    return model, _transformed(model, tagged)


def prepare(
    train: DataFrame, test: DataFrame, source: DataFrame | None = None
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """M7: fit the feature pipeline on ``train`` and transform both frames. ``source``,
    the rows of ``train`` before a shuffle, saves the fit that shuffle."""
    model = feature_pipeline(train if source is None else source)
    return model, _transformed(model, train), _transformed(model, test)


def _transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(df.columns + [c + "_Index" for c in CATEGORY_COLUMNS] + [FEATURES, LABEL])


def feature_names(df: DataFrame, col: str = FEATURES) -> list[str]:
    """The name of each place of the assembled vectors, from the column metadata."""
    kinds = df.schema[col].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for kind in kinds for a in kind), key=lambda a: a["idx"])]


def vector_summary(df: DataFrame, by: Sequence[str] = (), col: str = FEATURES) -> DataFrame:
    """M5, M6: for each place of the vectors its name, sum and number of values
    other than zero, and the number of vectors; for each group of ``by``.
    One distributed aggregate over the (sparse) vectors."""
    names = feature_names(df, col)
    summed = df.groupBy(*by).agg(Summarizer.metrics("count", "sum", "numNonZeros").summary(F.col(col)).alias("_s"))
    places = F.arrays_zip(
        F.lit(names).alias("feature"),
        vector_to_array("_s.sum").alias("total"),
        vector_to_array("_s.numNonZeros").alias("nonzero"),
    )
    rows = summed.select(*by, F.col("_s.count").alias("vectors"), F.explode(places).alias("_p"))
    return rows.select(
        *by, F.col("_p.feature").alias("feature"), "vectors",
        F.col("_p.total").alias("total"), F.col("_p.nonzero").cast("long").alias("nonzero"),
    )


#: Partitions that models are fitted on, at least, and the most rows meant for one: fits
#: left to Spark keep a row's whole vector (about 1 KB for trees), and a
#: partition that doesn't fit into memory is read from disk in each pass. The number is
#: part of a fit, so it follows from the rows and not from the input's layout.
FIT_PARTITIONS = 8
FIT_ROWS = 250_000


def fit_partitions(df: DataFrame, least: int = FIT_PARTITIONS) -> int:
    """Partitions to fit models on: ``least``, more for more than that many times FIT_ROWS."""
    return max(least, -(-df.count() // FIT_ROWS))


def laid_out(df: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """The rows dealt to ``partitions`` by a hash of all their values and sorted
    within: the same layout from any input, so that fits are the same on any
    cluster and use all its cores."""
    text = [c for c, kind in df.dtypes if kind != "vector"]
    return df.repartition(partitions, F.xxhash64(*text)).sortWithinPartitions(*text)


def feature_width(df: DataFrame, col: str = FEATURES) -> int:
    """Length of the assembled vectors, read from the column metadata."""
    return int(df.schema[col].metadata["ml_attr"]["num_attrs"])


def decision_tree(max_depth: int = 3, seed: int = 42) -> Estimator:
    """M9: Spark's decision tree, fitted over sparse rows."""
    return SparseDecisionTree(labelCol=LABEL, featuresCol=FEATURES, maxDepth=max_depth, seed=seed)


def random_forest(seed: int = 1) -> Estimator:
    """Spark's random forest and defaults (20 trees, depth 5), seeded, fitted over sparse rows."""
    return SparseRandomForest(labelCol=LABEL, featuresCol=FEATURES, seed=seed)


def perceptron(
    input_width: int,
    hidden: Sequence[int] = (800, 800),
    classes: int = 3,
    max_iter: int = 100,
    block_size: int = 128,
    seed: int = 1234,
) -> Estimator:
    """Input width comes from the data (``feature_width``), not a constant; Spark's
    perceptron, fitted over sparse rows."""
    layers = [input_width, *hidden, classes]
    return SparsePerceptron(
        labelCol=LABEL, featuresCol=FEATURES, layers=layers,
        maxIter=max_iter, blockSize=block_size, seed=seed,
    )


# One-vs-rest fits one binary model per class; they are independent and share their
# passes. Fits left to Spark run as concurrent jobs (one per class of the three labels).
OVR_PARALLELISM = 3


def logistic_one_vs_rest(max_iter: int = 10, parallelism: int = OVR_PARALLELISM) -> Estimator:
    """One-vs-rest over binary logistic regression, fitted over sparse rows."""
    lr = LogisticRegression(labelCol=LABEL, featuresCol=FEATURES, maxIter=max_iter)
    return SparseOneVsRest(classifier=lr, labelCol=LABEL, featuresCol=FEATURES, parallelism=parallelism)


def svm_one_vs_rest(
    max_iter: int = 10, reg_param: float = 0.1, parallelism: int = OVR_PARALLELISM
) -> Estimator:
    """One-vs-rest over a linear SVM, fitted over sparse rows."""
    svc = LinearSVC(labelCol=LABEL, featuresCol=FEATURES, maxIter=max_iter, regParam=reg_param)
    return SparseOneVsRest(classifier=svc, labelCol=LABEL, featuresCol=FEATURES, parallelism=parallelism)


def confusion(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n): the confusion matrix, at most classes^2 rows."""
    return predictions.groupBy(
        F.col(LABEL).cast("double").alias("label"), F.col(PREDICTION).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def scores(predictions: DataFrame) -> DataFrame:
    """One row (f1, accuracy), computed from the confusion matrix.

    Weighted f1 is the per-class F1 averaged with class frequencies as
    weights (a class with zero precision and recall counts as F1 0), the
    definition of Spark's multiclass evaluator. No rows give 0 and 0.
    """
    return _cell_scores(confusion(predictions))


def _cell_scores(cells: DataFrame) -> DataFrame:
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = cells.groupBy("label").agg(F.sum("n").alias("actual"), F.sum(hit).alias("hits"))
    guessed = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("guessed"))
    # At most one row for each class on either side.
    both = actual.join(F.broadcast(guessed), "label", "left")
    # 2PR / (P + R) with P = hits / guessed and R = hits / actual.
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.coalesce("guessed", F.lit(0)))
    total = F.sum("actual")
    return both.select(
        F.coalesce(F.round(F.sum(f1 * F.col("actual")) / total, 12), F.lit(0.0)).alias("f1"),
        F.coalesce(F.round(F.sum("hits") / total, 12), F.lit(0.0)).alias("accuracy"),
    )


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """The scores of a prediction frame as numbers. The cells, classes^2 at most, are
    held, so rows are predicted once and not for either side of a join."""
    cells = confusion(predictions)
    held = predictions.sparkSession.createDataFrame(cells.collect(), cells.schema)
    return _cell_scores(held).first().asDict()


# The classifiers compared and the names they are reported under.
def default_models() -> dict[str, Estimator]:
    return {
        "Decision Tree": decision_tree(),
        "Random Forest": random_forest(),
        "Logistic Regression (one-vs-rest)": logistic_one_vs_rest(),
        "Linear SVM (one-vs-rest)": svm_one_vs_rest(),
    }


def without_summary(model: Model) -> Model:
    """``model`` without its training summaries. A summary of two classes keeps the
    session, which can't be sent to executors once any frame was observed in it;
    predicting needs no summary."""
    nothing = SparkContext._active_spark_context._jvm.scala.Option.empty()
    for one in getattr(model, "models", [model]):
        if getattr(one, "hasSummary", False):
            one._java_obj.setSummary(nothing)
    return model


COMPARISON_SCHEMA = T.StructType([
    T.StructField("algorithm", T.StringType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("seconds", T.DoubleType()),
])


def compare_models(
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Estimator] | None = None,
) -> DataFrame:
    """Fit each model on ``train``, score it on ``test``; one row per model
    (algorithm, f1, accuracy, seconds for fit and score). Fits read the frames'
    partitions as they are; see ``laid_out``."""
    models = default_models() if models is None else models
    # Only what fitting and scoring read, and there before the clock starts.
    train, test = (f.select(FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK) for f in (train, test))
    rows = []
    try:
        train.count(), test.count()
        for name, estimator in models.items():
            start = time.perf_counter()
            fitted = without_summary(estimator.fit(train))
            found = evaluate(fitted.transform(test))
            rows.append((name, found["f1"], found["accuracy"], time.perf_counter() - start))
    finally:
        train.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(rows, COMPARISON_SCHEMA)
