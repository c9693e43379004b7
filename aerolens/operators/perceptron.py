"""The perceptron's fit (M11) over sparse rows.

Spark's own fit writes every row out as a dense vector (about 2 KB for flights,
whose vectors hold nine values), keeps all of them and multiplies by their
zeros in each pass. Here the rows are packed once, values and places only; in a
pass each task multiplies small blocks by the places that occur in them, and
losses and gradients are added up in two steps. Objective, start, optimizer and
stopping rule are those of Spark's estimator, so the weights are the same but
for rounding; the start and the fitted model are Spark's.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]

#: About the rows that are multiplied at once; dense, they stay in a core's cache.
PACKED_ROWS = 1024
#: So many partial sums at most come to the driver as they are.
DIRECT_SUMS = 16

PACKED = pa.schema([(c, pa.binary()) for c in ("labels", "lengths", "places", "values", "used")])
SUMMED = pa.schema([("part", pa.int32()), ("blocks", pa.int64()), ("loss", pa.float64()), ("gradient", pa.binary())])


class SparsePerceptron(MultilayerPerceptronClassifier):
    """Spark's perceptron, fitted over sparse rows by L-BFGS. ``blockSize`` weighs the
    rows as there: each block of a partition's consecutive rows counts alike."""

    def _fit(self, dataset: DataFrame):
        if self.getSolver() != "l-bfgs":
            return super()._fit(dataset)
        start = self._model().weights.toArray()
        per = self.getBlockSize()
        packed = _packed(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getLayers(), per)
        packed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights = minimized(_objective(packed, self.getLayers(), per), start, self.getMaxIter(), self.getTol())
        finally:
            packed.unpersist()
        return self._copyValues(self._model(weights))

    def _model(self, weights: np.ndarray | None = None):
        """Spark's model with these weights, by default those it starts from: its fit
        of no iterations, to one empty row."""
        from aerolens.operators.ml import without_summary  # which imports this module

        still = self.copy({self.maxIter: 0})
        if weights is not None:
            still.setInitialWeights(DenseVector(weights))
        row = (Vectors.sparse(self.getLayers()[0], {}), 0.0)
        one = SparkSession.active().createDataFrame([row], [self.getFeaturesCol(), self.getLabelCol()])
        return without_summary(MultilayerPerceptronClassifier._fit(still, one))


def _maps(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of a weight vector: each layer's matrix (inputs by outputs) and bias."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((flat[at : at + n * m].reshape(n, m), flat[at + n * m : at + n * m + m]))
        at += n * m + m
    return out


def _packed(df: DataFrame, features: str, label: str, layers: Sequence[int], per: int) -> DataFrame:
    """The rows of each partition, in their order, as blocks of about PACKED_ROWS."""
    size, vector = per * max(1, PACKED_ROWS // per), F.unwrap_udt(F.col(features))
    everywhere = F.sequence(F.lit(0), F.lit(layers[0] - 1))
    rows = df.select(
        F.col(label).cast("int").alias("label"),
        F.coalesce(vector["indices"], everywhere).alias("places"),
        vector["values"].alias("values"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                table = pa.Table.from_batches(held)
                for at in range(0, n - size + 1, size):
                    yield _block(table.slice(at, size), layers[-1])
                held, n = table.slice(n - n % size).to_batches(), n % size
        if n:
            yield _block(pa.Table.from_batches(held), layers[-1])

    return rows.mapInArrow(pack, "labels binary, lengths binary, places binary, values binary, used binary")


def _block(table: pa.Table, classes: int) -> pa.RecordBatch:
    one = table.combine_chunks()
    label, places, values = (c.chunk(0) for c in one.columns)
    if label.null_count or values.null_count:
        raise ValueError("a row to fit has no label or no vector")
    labels = label.to_numpy()
    if labels.min() < 0 or labels.max() >= classes:
        raise ValueError(f"a label isn't one of {classes} classes")
    used, local = np.unique(places.flatten().to_numpy(), return_inverse=True)
    parts = [
        labels.astype(np.int32), values.value_lengths().to_numpy().astype(np.int32),
        local.astype(np.uint16 if len(used) < 2**16 else np.int32), values.flatten().to_numpy(), used.astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], schema=PACKED)


def _dense(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's labels, the places used in it, and its rows over these."""
    labels, lengths, used = (np.frombuffer(block[c], np.int32) for c in ("labels", "lengths", "used"))
    places = np.frombuffer(block["places"], np.uint16 if len(used) < 2**16 else np.int32)
    x = np.zeros((len(labels), len(used)))
    x[np.repeat(np.arange(len(labels)), lengths), places] = np.frombuffer(block["values"])
    return labels, used, x


def _add_block(block: dict, maps: list, sums: list, per: int) -> tuple[int, float]:
    """Add a block's gradient to ``sums``; its number of Spark's blocks, and its loss."""
    labels, used, x = _dense(block)
    n = len(labels)
    share = np.full(n, 1.0 / per)
    share[n - n % per :] = 1.0 / max(1, n % per)
    inputs, z = [x], x @ maps[0][0][used] + maps[0][1]
    for matrix, bias in maps[1:]:
        np.exp(np.negative(z, out=z), out=z)
        z += 1.0
        inputs.append(np.reciprocal(z, out=z))
        z = z @ matrix + bias
    z -= z.max(axis=1, keepdims=True)
    rows, delta = np.arange(n), np.exp(z)
    total = delta.sum(axis=1)
    loss = float(share @ (np.log(total) - z[rows, labels]))
    delta /= total[:, None]
    delta[rows, labels] -= 1.0
    delta *= share[:, None]
    for k in range(len(maps) - 1, 0, -1):
        sums[k][0][...] += inputs[k].T @ delta
        sums[k][1][...] += delta.sum(axis=0)
        delta = delta @ maps[k][0].T
        delta *= inputs[k] * (1.0 - inputs[k])
    sums[0][0][used] += x.T @ delta
    sums[0][1][...] += delta.sum(axis=0)
    return -(-n // per), loss


def _summed(part: int, blocks: int, loss: float, gradient: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"part": part, "blocks": blocks, "loss": loss, "gradient": gradient.tobytes()}], schema=SUMMED
    )


def _total(rows: list[dict]) -> tuple[int, float, np.ndarray]:
    """Partial sums added up by partition, so that rounding is the same each time."""
    rows = sorted(rows, key=lambda r: r["part"])
    gradient = sum(np.frombuffer(r["gradient"]) for r in rows)
    return sum(r["blocks"] for r in rows), sum(r["loss"] for r in rows), gradient


def _objective(packed: DataFrame, layers: Sequence[int], per: int) -> Objective:
    """Mean loss of the blocks and its gradient, from one pass over the packed rows."""
    context, kind = packed.sparkSession.sparkContext, "part int, blocks long, loss double, gradient binary"
    layers, parts = list(layers), packed.rdd.getNumPartitions()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield _summed(min(r["part"] for r in rows), *_total(rows))

    def objective(weights: np.ndarray) -> tuple[float, np.ndarray]:
        sent = context.broadcast(weights)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gradient, blocks, loss = np.zeros(len(sent.value)), 0, 0.0
            maps, sums = _maps(sent.value, layers), _maps(gradient, layers)
            with np.errstate(over="ignore"):
                for batch in batches:
                    for block in batch.to_pylist():
                        n, lost = _add_block(block, maps, sums, per)
                        blocks, loss = blocks + n, loss + lost
            if blocks:
                yield _summed(TaskContext.get().partitionId(), blocks, loss, gradient)

        found = packed.mapInArrow(add, kind)
        if parts > DIRECT_SUMS:
            found = found.repartition(math.isqrt(parts), "part").mapInArrow(merge, kind)
        rows = [r.asDict() for r in found.collect()]
        sent.destroy()
        if not rows:
            raise ValueError("no rows to fit")
        blocks, loss, gradient = _total(rows)
        return loss / blocks, gradient / blocks

    return objective


class _NoStep(ArithmeticError):
    """The search finds no step in this direction."""


def _direction(history: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    """L-BFGS: the descent direction by the last steps and gradient changes, newest first."""
    out, kept = gradient.copy(), []
    for step, change in history:
        along = step @ change
        share = (step @ out) / along
        if math.isnan(share):
            raise _NoStep("history")
        out -= share * change
        kept.append((step, change, along, share))
    if history:
        step, change = history[0]
        if not step @ change >= 0:
            raise _NoStep("history")
        out *= (step @ change) / (change @ change)
    for step, change, along, share in reversed(kept):
        out += (share - (change @ out) / along) * step
    return -out


def _between(low: tuple, high: tuple) -> float:
    """Where the cubic through two ends (place, value, slope) is least, off the ends."""
    (a, fa, da), (b, fb, db) = sorted((low, high))
    d1 = da + db - 3 * (fa - fb) / (a - b)
    root = d1 * d1 - da * db
    d2 = math.sqrt(root) if root >= 0 else math.nan
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2)
    return a + 0.1 * (b - a) if t < a + 0.1 * (b - a) else a + 0.9 * (b - a) if t > a + 0.9 * (b - a) else t


def _step_size(phi: Callable[[float], tuple], t: float, tries: int = 10) -> float:
    """A step by the strong Wolfe conditions, from ``t`` on; ``phi`` gives (place, value, slope)."""
    _, value, slope = low = phi(0.0)
    if slope > 0:
        raise _NoStep("not a descent")

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(tries):
            c = phi(_between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _NoStep("zoom")

    for i in range(tries):
        c = phi(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (i and c[1] >= low[1]):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _NoStep("search")


def _halved(phi: Callable[[float], tuple], t: float, value: float, shrink: float, tries: int = 20) -> float:
    """A step by backtracking under the strong Wolfe conditions, as Spark's orthant-wise
    optimizer takes it: the first place is given the value of the start."""
    _, first, slope = phi(0.0)
    # The slope at the first place isn't looked at if the step is cut there anyway.
    steep = 0.0 if value > first + t * slope * 1e-4 else phi(t)[2]
    for _ in range(tries - 1):
        if value > first + t * slope * 1e-4:
            by = shrink
        elif steep < 0.9 * slope:
            by = 2.1
        elif steep > -0.9 * slope:
            by = shrink
        else:
            break
        t *= by
        if not 1e-10 <= t <= 1e10:
            raise _NoStep("step size")
        _, value, steep = phi(t)
    return t


def minimized(
    objective: Objective, x: np.ndarray, max_iter: int, tol: float, memory: int = 10, orthants: bool = False
) -> np.ndarray:
    """L-BFGS with a strong Wolfe search, as Spark's fit runs it: until ``max_iter`` steps,
    a value that no longer falls, a flat place, or two directions without a step in turn.
    ``orthants``: as its orthant-wise form without an L1 term runs, which leaves out what
    goes against the gradient and stops each weight where its sign would change."""
    last: list = [None, None]

    def at(place: np.ndarray) -> tuple[float, np.ndarray]:
        if last[0] is None or not np.array_equal(last[0], place):
            last[:] = place, objective(place)
        return last[1]

    value, gradient = at(x)
    start, values, history, failed, done = abs(value), [math.inf], [], False, 0
    with np.errstate(divide="ignore", invalid="ignore"):
        while done < max_iter:
            if len(values) > 1 and abs(value - max(values)) <= tol * start:
                break
            if np.linalg.norm(gradient) <= max(tol * abs(value), 1e-8):
                break
            try:
                way = _direction(history, gradient)
                if orthants:
                    way = np.where(way * gradient < 0, way, 0.0)
                signs = np.where(x != 0, np.sign(x), np.sign(-gradient)) if orthants else None

                def place(t: float, x=x, way=way, signs=signs) -> np.ndarray:
                    to = x + way * t
                    return to if signs is None else np.where(np.sign(to) == signs, to, 0.0)

                def phi(t: float, place=place, way=way) -> tuple[float, float, float]:
                    found, slope = at(place(t))
                    return t, found, float(slope @ way)

                if orthants:
                    first = 1.0 if done else 0.5 / np.linalg.norm(gradient)
                    size = _halved(phi, first, value, 0.5 if done else 0.1)
                else:
                    size = _step_size(phi, 1.0 if done else 1.0 / np.linalg.norm(way))
                    if size * np.linalg.norm(gradient) < 1e-10:
                        raise _NoStep("underflow")
            except _NoStep:
                if failed:
                    break
                failed, history = True, []
                continue
            new = place(size)
            value, grown = at(new)
            history = [(new - x, grown - gradient), *history][:memory]
            x, gradient, failed, done = new, grown, False, done + 1
            values = [*values, value][-20:]
    return x
