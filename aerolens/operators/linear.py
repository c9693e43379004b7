"""One-vs-rest over logistic regression and the linear SVM (M12, M13), fitted over
sparse rows.

Spark's own fit makes a copy of the rows for each class, standardized, and takes their
means and deviations for each class anew. Here the rows are packed once for all
classes and taken as they are, standardized through the weights; the classes' fits ask
for losses and gradients together, so that one pass over the rows answers them all.
Objectives, starts, optimizers and stopping rules are those of Spark's estimators, so
the weights are the same but for rounding; the fitted models are Spark's.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Condition

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.operators.perceptron import minimized
from aerolens.operators.trees import in_blocks, in_few_tasks, values_of

#: Rows that are multiplied at once.
PACKED_ROWS = 8192
#: So many bytes of partial sums at most come to the driver as they are.
DIRECT_BYTES = 16 << 20

#: Classes that are told apart here; more are left to Spark's own fit.
CLASSES = 100

FIELDS = ("labels", "full", "table", "lengths", "places", "values", "used")
PACKED = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in FIELDS)])
#: Types that a block's numbers and counts are kept in, the smallest that holds them all.
NUMBERS = (np.int8, np.int16, np.float32, np.float64)
COUNTS = (np.uint8, np.uint16, np.int32)
SUMMED = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


class SparseOneVsRest(OneVsRest):
    """Spark's one-vs-rest, its classes fitted together over sparse rows."""

    def _fit(self, dataset: DataFrame):
        classifier = self.getClassifier()
        width = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs")
        if not width or not _covered(self, classifier):
            return super()._fit(dataset)
        packed = _packed(dataset, self.getFeaturesCol(), self.getLabelCol(), width)
        packed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = _summary(packed, width)
            if rows is None:  # a class without rows, or with all
                return super()._fit(dataset)
            together = Together(packed, rows, isinstance(classifier, LogisticRegression))
            fits = [_weights(classifier, rows, k, together) for k in range(len(rows.counts))]
            found = together.run(fits)
        finally:
            packed.unpersist()
        # As in Spark, each model knows the label column of its own class.
        own = [
            {classifier.labelCol: f"mc2b${k}", classifier.featuresCol: self.getFeaturesCol(),
             classifier.predictionCol: self.getPredictionCol()}
            for k in range(len(found))
        ]
        models = [_model(classifier.copy(params), w) for params, w in zip(own, found, strict=True)]
        return self._copyValues(OneVsRestModel(models=models))


def _covered(estimator: OneVsRest, classifier) -> bool:
    """Whether what is asked for is fitted here, and not by Spark's own fit."""
    if any(e.isDefined(e.weightCol) and e.getWeightCol() for e in (estimator, classifier)):
        return False
    if not (classifier.getFitIntercept() and classifier.getStandardization()):
        return False
    if type(classifier) is LinearSVC:
        return True
    bounds = ("lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")
    return (
        type(classifier) is LogisticRegression
        and not any(classifier.isDefined(classifier.getParam(b)) for b in bounds)
        and (classifier.getElasticNetParam() == 0.0 or classifier.getRegParam() == 0.0)
        and classifier.getFamily() in ("auto", "binomial")
    )


def _model(classifier, weights: np.ndarray):
    jvm, context = SparkContext._active_spark_context._jvm.org.apache.spark.ml.classification, SparkContext._active_spark_context
    java, python = (
        (jvm.LogisticRegressionModel, LogisticRegressionModel)
        if isinstance(classifier, LogisticRegression)
        else (jvm.LinearSVCModel, LinearSVCModel)
    )
    coefficients = _py2java(context, DenseVector(weights[:-1]))
    return classifier._copyValues(python(java(classifier.uid, coefficients, float(weights[-1]))))


def _packed(df: DataFrame, features: str, label: str, width: int) -> DataFrame:
    """The rows of each partition, in their order, as blocks of PACKED_ROWS: a table of
    the places that most rows have a value at, and all other values by row."""
    rows = df.select(
        F.spark_partition_id().alias("part"), F.col(label).cast("double").alias("label"), *values_of(df, features, width)
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_block(table, width) for table in in_blocks(batches, PACKED_ROWS))

    return rows.mapInArrow(pack, ", ".join(["part int", *(f"{c} binary" for c in FIELDS)]))


def _small(values: np.ndarray, kinds: Sequence[type]) -> np.ndarray:
    """The values in the first of these types, one for each size, that holds them all exactly."""
    for kind in kinds[:-1]:
        with np.errstate(invalid="ignore", over="ignore"):
            small = values.astype(kind)
        if (small == values).all():
            return small
    return values.astype(kinds[-1])


def _read(data: bytes, count: int, kinds: Sequence[type]) -> np.ndarray:
    """So many values, whose size tells their type."""
    size = len(data) // count if count else np.dtype(kinds[-1]).itemsize
    return np.frombuffer(data, next(k for k in kinds if np.dtype(k).itemsize == size))


def _block(table: pa.Table, width: int) -> pa.RecordBatch:
    part, label, places, values = (c.chunk(0) for c in table.combine_chunks().columns)
    if label.null_count or values.null_count:
        raise ValueError("a row to fit has no label or no vector")
    labels, lengths = label.to_numpy(), values.value_lengths().to_numpy()
    if not (labels >= 0).all() or (labels != np.floor(labels)).any():
        raise ValueError("a label isn't the number of a class")
    place, value = places.flatten().to_numpy(), values.flatten().to_numpy()
    if not np.isfinite(value).all():
        raise ValueError("a vector holds NaN or infinity")
    n, own = len(labels), np.repeat(np.arange(len(labels)), lengths)
    full = np.flatnonzero(np.bincount(place, minlength=width) * 2 > n)
    at = np.full(width, -1)
    at[full] = np.arange(len(full))
    in_full = at[place] >= 0
    dense = np.zeros((len(full), n))
    dense[at[place[in_full]], own[in_full]] = value[in_full]
    rest = ~in_full
    used, local = np.unique(place[rest], return_inverse=True)
    ones = (value[rest] == 1.0).all()
    parts = [
        np.minimum(labels, CLASSES).astype(np.uint8), full.astype(np.int32), _small(dense, NUMBERS),
        _small(np.bincount(own[rest], minlength=n), COUNTS), _small(local, COUNTS),
        value[rest][: 0 if ones else None], used.astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays(
        [part.slice(0, 1), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], schema=PACKED
    )


@dataclass
class Block:
    """A block's labels, its table, and its other values in slots: the rows that have so
    many values, with place and value (None: one) of the next."""

    labels: np.ndarray
    full: np.ndarray
    table: np.ndarray
    slots: list[tuple[np.ndarray | slice, np.ndarray, np.ndarray | None]]
    used: np.ndarray


def _unpacked(block: dict) -> Block:
    labels, full, used = (np.frombuffer(block[c], k) for c, k in (("labels", np.uint8), ("full", np.int32), ("used", np.int32)))
    n, lengths = len(labels), _read(block["lengths"], len(labels), COUNTS).astype(np.int64)
    places = _read(block["places"], int(lengths.sum()), COUNTS)
    values, first, slots = np.frombuffer(block["values"]), np.cumsum(lengths) - lengths, []
    for j in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > j)
        at = first[rows] + j
        own = slice(None) if len(rows) == n else rows
        slots.append((own, places[at].astype(np.int64), values[at] if len(values) else None))
    table = _read(block["table"], len(full) * n, NUMBERS).astype(float).reshape(len(full), n)
    return Block(labels, full, table, slots, used)


def _pass(packed: DataFrame, start: Callable[[], np.ndarray], add: Callable[[Block, np.ndarray], None],
          merge: Callable[[list[np.ndarray]], np.ndarray], size: int) -> np.ndarray | None:
    """What ``add`` gathers from the blocks of each partition, brought together in the
    order of the partitions so that rounding is the same each time; None without rows."""
    kind, parts = "part int, sums binary", packed.rdd.getNumPartitions()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = -1, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "sums": sums.tobytes()}], schema=SUMMED)

        for batch in batches:
            for block in batch.to_pylist():
                if block["part"] != part:
                    if sums is not None:
                        yield row()
                    part, sums = block["part"], start()
                add(_unpacked(block), sums)
        if sums is not None:
            yield row()

    def merged(rows: list[dict]) -> dict:
        rows = sorted(rows, key=lambda r: r["part"])
        return {"part": rows[0]["part"], "sums": merge([np.frombuffer(r["sums"]) for r in rows]).tobytes()}

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_pylist([merged(rows)], schema=SUMMED)

    found = in_few_tasks(packed).mapInArrow(gather, kind)
    if parts * size * 8 > DIRECT_BYTES:
        found = found.repartition(math.isqrt(parts), "part").mapInArrow(bring, kind)
    rows = [r.asDict() for r in found.collect()]
    return np.frombuffer(merged(rows)["sums"]) if rows else None


@dataclass
class Rows:
    """What the fits need to know of all rows: how many there are of each class, and
    mean and inverse deviation (zero for a constant) at each place."""

    counts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _summary(packed: DataFrame, width: int) -> Rows | None:
    """One pass: rows by class, and for each place mean and sum of squared deviations,
    merged block by block so that nothing large cancels out."""

    def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        (ca, ma, sa), (cb, mb, sb) = (np.split(x, [CLASSES + 1, CLASSES + 1 + width]) for x in (a, b))
        na, nb = ca.sum(), cb.sum()
        if not na:
            return b
        mean = ma + (mb - ma) * (nb / (na + nb))
        return np.concatenate([ca + cb, mean, sa + sb + (mb - ma) ** 2 * (na * nb / (na + nb))])

    def add(block: Block, sums: np.ndarray) -> None:
        n, mean, squares = len(block.labels), np.zeros(width), np.zeros(width)
        for rows, places, values in block.slots:
            one = np.ones(len(places)) if values is None else values
            mean[block.used] += np.bincount(places, one, len(block.used))
            squares[block.used] += np.bincount(places, one * one, len(block.used))
        mean /= n
        squares -= n * mean * mean
        mean[block.full] = block.table.mean(axis=1)
        squares[block.full] = ((block.table - mean[block.full][:, None]) ** 2).sum(axis=1)
        counts = np.bincount(block.labels, minlength=CLASSES + 1)
        sums[:] = combined(sums, np.concatenate([counts, mean, squares]))

    def merge(found: list[np.ndarray]) -> np.ndarray:
        total = found[0]
        for one in found[1:]:
            total = combined(total, one)
        return total

    size = CLASSES + 1 + 2 * width
    found = _pass(packed, lambda: np.zeros(size), add, merge, size)
    if found is None:
        return None
    counts, mean, squares = np.split(found, [CLASSES + 1, CLASSES + 1 + width])
    classes, n = int(np.flatnonzero(counts)[-1]) + 1, counts.sum()
    if classes > CLASSES or classes < 2 or (counts[:classes] == 0).any():
        return None
    deviation = np.sqrt(np.maximum(squares, 0.0) / (n - 1))
    scale = np.divide(1.0, deviation, out=np.zeros(width), where=deviation != 0)
    return Rows(counts[:classes], mean, scale)


def _add_block(block: Block, asked: list[tuple[int, np.ndarray]], logistic: bool, sums: np.ndarray) -> None:
    """Add, for each class asked for, a block's loss, the sum of the derivatives by the
    margin, and the gradient; weights are for the values as they are, intercept last."""
    n, used = len(block.labels), block.used
    width = sums.shape[1] - 2
    held = [(rows, places, values, slice(None) if isinstance(rows, slice) else rows) for rows, places, values in block.slots]
    margins = np.stack([w[block.full] for _, w in asked]) @ block.table
    for k, (label, weights) in enumerate(asked):
        margin, own = margins[k], weights[used]
        margin += weights[width]
        for rows, places, values, at in held:
            part = own[places] if values is None else own[places] * values
            margin[at] += part
        mine = block.labels == label
        if logistic:
            # log(1 + exp(-m)) or log(1 + exp(m)), and the derivative.
            signed = np.where(mine, -margin, margin)
            small = np.exp(-np.abs(signed))
            sums[k, 0] += (np.log1p(small) + np.maximum(signed, 0.0)).sum()
            chance = np.where(margin >= 0, 1.0, small) / (1.0 + small)
            slope = chance - mine
        else:
            sign = np.where(mine, 1.0, -1.0)
            lost = 1.0 - sign * margin
            sums[k, 0] += lost[lost > 0].sum()
            slope = np.where(lost > 0, -sign, 0.0)
        margins[k] = slope
        sums[k, 1] += slope.sum()
        for rows, places, values, at in held:
            part = slope[at] if values is None else slope[at] * values
            sums[k, 2 + used] += np.bincount(places, part, len(used))
    sums[:, 2 + block.full] += margins @ block.table.T


class Together:
    """Losses and gradients for the fits of several classes, each in a thread: a pass
    starts once every fit that still runs has asked for one."""

    def __init__(self, packed: DataFrame, rows: Rows, logistic: bool) -> None:
        self.packed, self.rows, self.logistic = packed, rows, logistic
        self.turn, self.running = Condition(), set()
        self.asked: dict[int, np.ndarray] = {}
        self.found: dict[int, tuple[float, float, np.ndarray] | BaseException] = {}

    def run(self, fits: list[Callable[[], np.ndarray]]) -> list[np.ndarray]:
        from pyspark import inheritable_thread_target

        self.running = set(range(len(fits)))

        def one(k: int) -> np.ndarray:
            try:
                return fits[k]()
            finally:
                with self.turn:
                    self.running.discard(k)
                    self._go()

        with ThreadPool(len(fits)) as pool:
            own = inheritable_thread_target(self.packed.sparkSession)
            waiting = [pool.apply_async(own(one), (k,)) for k in range(len(fits))]
            return [w.get() for w in waiting]

    def ask(self, k: int, weights: np.ndarray) -> tuple[float, float, np.ndarray]:
        with self.turn:
            self.asked[k] = weights
            self._go()
            self.turn.wait_for(lambda: k in self.found)
            found = self.found.pop(k)
        if isinstance(found, BaseException):
            raise found
        return found

    def _go(self) -> None:
        if not self.asked or set(self.asked) != self.running:
            return
        asked, self.asked = sorted(self.asked.items()), {}
        try:
            sums = self._sums(asked)
            self.found |= {k: (s[0], s[1], s[2:]) for (k, _), s in zip(asked, sums, strict=True)}
        except BaseException as e:  # each fit ends with it
            self.found |= {k: e for k, _ in asked}
        self.turn.notify_all()

    def _sums(self, asked: list[tuple[int, np.ndarray]]) -> np.ndarray:
        shape, logistic = (len(asked), len(self.rows.mean) + 2), self.logistic
        sent = self.packed.sparkSession.sparkContext.broadcast(asked)

        def add(block: Block, sums: np.ndarray) -> None:
            _add_block(block, sent.value, logistic, sums.reshape(shape))

        size = shape[0] * shape[1]
        found = _pass(self.packed, lambda: np.zeros(size), add, lambda parts: np.sum(parts, axis=0), size)
        sent.destroy()
        return found.reshape(shape)


def _weights(classifier, rows: Rows, k: int, together: Together) -> Callable[[], np.ndarray]:
    """The fit of one class against the rest: its weights, intercept last."""
    n, center = rows.counts.sum(), rows.mean * rows.scale
    reg, logistic = classifier.getRegParam(), isinstance(classifier, LogisticRegression)

    def raw(weights: np.ndarray) -> np.ndarray:
        return np.append(weights[:-1] * rows.scale, weights[-1] - weights[:-1] @ center)

    def objective(weights: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope, gradient = together.ask(k, raw(weights))
        inner = (gradient * rows.scale - slope * center) / n + reg * weights[:-1]
        return loss / n + 0.5 * reg * float(weights[:-1] @ weights[:-1]), np.append(inner, slope / n)

    def fit() -> np.ndarray:
        start = np.zeros(len(center) + 1)
        if logistic:
            start[-1] = math.log(rows.counts[k] / (n - rows.counts[k]))
        return raw(minimized(objective, start, classifier.getMaxIter(), classifier.getTol(), orthants=not logistic))

    return fit
