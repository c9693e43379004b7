"""Model flows over the classifier input (M1-M15 composed).

Order: seeded split, encoders fitted on the training part, both parts
transformed, models fitted and scored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.operators import ml


def stratified_split_counts(model_rows: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """M1/M2: rows per Year and part of a seeded per-row split."""
    tagged = ml.tag_split(model_rows, train_fraction, seed)
    return tagged.groupBy("Year", "part").agg(F.count(F.lit(1)).alias("Number"))


def prepared_parts(
    model_rows: DataFrame, seed: int = 42, partitions: int = ml.FIT_PARTITIONS
) -> tuple[DataFrame, DataFrame]:
    """M8 then M3-M7: seeded 70/30 split, feature pipeline fitted on the 70 %
    (from any layout, so before the shuffle), each part laid out for fitting on
    ``partitions`` or, if the rows are many, more."""
    count = ml.fit_partitions(model_rows, partitions)
    train, test = ml.parts(ml.tag_split(model_rows, 0.7, seed))
    return ml.prepare(ml.laid_out(train, count), ml.laid_out(test, count), train)[1:]


def _prepared(model_rows: DataFrame, seed: int) -> DataFrame:
    return ml.prepare_tagged(ml.tag_split(model_rows, 0.7, seed))[1]


def feature_vectors(model_rows: DataFrame, seed: int = 42) -> DataFrame:
    """M3-M7: every row that survives encoding, with what its (sparse) vector
    is made of, category indices and numbers, its label index and its part.
    One scan fits the encoders, one transforms all rows."""
    columns = [c + "_Index" for c in ml.CATEGORY_COLUMNS] + [*ml.NUMERIC_COLUMNS, ml.LABEL]
    return _prepared(model_rows, seed).select(*columns, "part")


def vector_summary(model_rows: DataFrame, seed: int = 42) -> DataFrame:
    """M5, M6: what the vectors of each part add up to, place by place."""
    return ml.vector_summary(_prepared(model_rows, seed), ["part"])


def rule_scores(labelled: DataFrame) -> DataFrame:
    """M14 over a fixed rule in place of a model: the departure delay, taken
    for the arrival delay, names the class."""
    # Class numbers, and the bounds that the labels use.
    number = lambda c: F.when(c == "Early", 0.0).when(c == "OnTime", 1.0).otherwise(2.0)
    delay = F.col("DEP_DELAY")
    guess = F.when(delay < -10, "Early").when(delay > 10, "Delay").otherwise("OnTime")
    return ml.scores(labelled.select(number(F.col("Labels")).alias(ml.LABEL), number(guess).alias(ml.PREDICTION)))


#: Hidden layers of the registered perceptron; the library's default is two of 800.
HIDDEN = (32, 16)


def perceptron_scores(model_rows: DataFrame, seed: int = 42, partitions: int = ml.FIT_PARTITIONS) -> DataFrame:
    """M11 with two hidden layers: its scores on the test part."""
    train_f, test_f = prepared_parts(model_rows, seed, partitions)
    estimator = ml.perceptron(ml.feature_width(train_f), hidden=HIDDEN, max_iter=10)
    return ml.compare_models(train_f, test_f, {"Multilayer Perceptron": estimator}).drop("seconds")


def model_comparison(model_rows: DataFrame, seed: int = 42, partitions: int = ml.FIT_PARTITIONS) -> DataFrame:
    """One row per classifier with f1, accuracy and seconds."""
    train_f, test_f = prepared_parts(model_rows, seed, partitions)
    return ml.compare_models(train_f, test_f)
