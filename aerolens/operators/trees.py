"""The fits of the decision tree and the random forest (M9, M10) over sparse rows.

Spark's own fit writes every row out as one bin for each place of its vector (over
1 KB for flights, whose vectors hold nine values), keeps these rows and visits all
places of each in every pass. Here the rows are packed once as the bins of the
values they hold, some 26 bytes; a pass counts those, and what a node's rows have at
zero follows from its total. Split candidates, the gain, the order of nodes, the
features drawn for a node, stopping and pruning are those of Spark's estimators, so
a tree is the same; a forest's bootstrap draws the same Poisson counts from another
generator. The fitted models are Spark's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are counted at once.
PACKED_ROWS = 8192
#: So many partial sums at most come to the driver as they are.
DIRECT_SUMS = 16
#: Spark takes split candidates from about so many rows, or from maxBins squared.
SPLIT_ROWS = 10_000

#: A pass starts so many Python tasks a core at most, as each takes some time to start.
TASKS = 3

PACKED = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("labels", "lengths", "cells"))])
SUMMED = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
EPSILON = float(np.finfo(float).eps)


class SparseDecisionTree(DecisionTreeClassifier):
    """Spark's decision tree, fitted over sparse rows."""

    def _fit(self, dataset: DataFrame):
        bins = _bins(self, dataset, 1, "all")
        if bins is None:
            return super()._fit(dataset)
        (root,) = _fitted(self, dataset, bins, 1, None)
        return self._copyValues(DecisionTreeClassificationModel(_java_tree(root, bins, self.uid)))


class SparseRandomForest(RandomForestClassifier):
    """Spark's random forest, fitted over sparse rows."""

    def _fit(self, dataset: DataFrame):
        trees, rate = self.getNumTrees(), self.getSubsamplingRate() if self.getBootstrap() else None
        bins = _bins(self, dataset, trees, self.getFeatureSubsetStrategy())
        if bins is None or (rate is None and self.getSubsamplingRate() < 1):
            return super()._fit(dataset)
        fitted = [_java_tree(root, bins) for root in _fitted(self, dataset, bins, trees, rate)]
        context = dataset.sparkSession.sparkContext
        jvm = context._jvm.org.apache.spark.ml.classification
        array = context._gateway.new_array(jvm.DecisionTreeClassificationModel, trees)
        for i, tree in enumerate(fitted):
            array[i] = tree
        model = jvm.RandomForestClassificationModel(self.uid, array, len(bins.sizes), bins.classes)
        return self._copyValues(RandomForestClassificationModel(model))


@dataclass
class Bins:
    """How values become bins. Bin b of feature f is cell ``starts[f] + b``; a binary
    feature has two bins, a number one more than it has split candidates."""

    classes: int
    binary: np.ndarray
    thresholds: dict[int, np.ndarray]
    rows: int
    per_node: int
    sizes: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    #: Where a value that a vector doesn't hold, zero, falls.
    zeros: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.sizes = np.array([2 if b else len(self.thresholds[f]) + 1 for f, b in enumerate(self.binary)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.zeros = np.array([0 if b else np.searchsorted(self.thresholds[f], 0.0) for f, b in enumerate(self.binary)])

    @property
    def cells(self) -> int:
        return int(self.sizes.sum())


def in_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """All rows of the batches, in their order, ``size`` at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            table = pa.Table.from_batches(held)
            for at in range(0, n - size + 1, size):
                yield table.slice(at, size)
            held, n = table.slice(n - n % size).to_batches(), n % size
    if n:
        yield pa.Table.from_batches(held)


def values_of(df: DataFrame, features: str, width: int) -> list[Column]:
    """Places and values that the vectors hold; a dense one holds all."""
    vector = F.unwrap_udt(F.col(features))
    everywhere = F.sequence(F.lit(0), F.lit(width - 1))
    return [F.coalesce(vector["indices"], everywhere).alias("places"), vector["values"].alias("values")]


def in_few_tasks(packed: DataFrame) -> DataFrame:
    """The blocks of several partitions in a task, one after another. Sums and draws go
    by the partition that a block names, so they are the same in any number of tasks."""
    return packed.coalesce(TASKS * packed.sparkSession.sparkContext.defaultParallelism)


def _bins(estimator, df: DataFrame, trees: int, strategy: str) -> Bins | None:
    """The bins that Spark's fit would use, or None for what only that fit covers."""
    features, label = (df.schema[c].metadata.get("ml_attr", {}) for c in (estimator.getFeaturesCol(), estimator.getLabelCol()))
    kinds, width, classes = features.get("attrs", {}), features.get("num_attrs"), len(label.get("vals", []))
    weighed = estimator.isDefined(estimator.weightCol) and estimator.getWeightCol()
    if not width or kinds.get("nominal") or classes < 3 or weighed or estimator.getImpurity() != "gini":
        return None
    strategy = strategy if strategy != "auto" else "all" if trees == 1 else "sqrt"
    rows = df.count()
    if strategy not in ("all", "sqrt") or rows < 2:
        return None
    binary = np.zeros(width, bool)
    binary[[a["idx"] for a in kinds.get("binary", [])]] = True
    numbers, most = np.flatnonzero(~binary), min(estimator.getMaxBins(), rows)
    per_node = width if strategy == "all" else math.ceil(math.sqrt(width))
    wanted = max(most * most, SPLIT_ROWS)
    share = wanted / rows if wanted < rows else 1.0
    found: list[list[np.ndarray]] = [[] for _ in numbers]
    if len(numbers):
        at = {int(f): k for k, f in enumerate(numbers)}
        for row in _sampled(df, estimator, share).select(*values_of(df, estimator.getFeaturesCol(), width)).collect():
            for place, value in zip(row["places"], row["values"], strict=True):
                if value != 0.0 and place in at:
                    found[at[place]].append(value)
    thresholds = {int(f): _thresholds(np.array(v), share * rows, rows, most - 1) for f, v in zip(numbers, found, strict=True)}
    return Bins(classes, binary, thresholds, rows, per_node)


def _sampled(df: DataFrame, estimator, share: float) -> DataFrame:
    """The rows that Spark's fit takes split candidates from."""
    rows = df.select(estimator.getFeaturesCol())
    if share >= 1.0:
        return rows
    session = df.sparkSession
    draw = session._jvm.org.apache.spark.util.random.XORShiftRandom(estimator.getSeed()).nextInt()
    drawn = rows._jdf.queryExecution().toRdd().sample(False, share, draw)
    return DataFrame(session._jsparkSession.internalCreateDataFrame(drawn, rows._jdf.schema(), False), session)


def _thresholds(values: np.ndarray, expected: float, rows: int, most: int) -> np.ndarray:
    """Split candidates of a number from a sample's values other than zero, as Spark
    finds them: between neighbours, at about equal counts if these are too many."""
    if not len(values):
        return np.zeros(0)
    distinct, counts = np.unique(values, return_counts=True)
    counts = counts.astype(float)
    if expected - len(values) > EPSILON * rows * 100:
        at = np.searchsorted(distinct, 0.0)
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, expected - len(values))
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= most:
        return between
    stride, current, out = expected / (most + 1), counts[0], []
    target = stride
    for i in range(1, len(distinct)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _packed(df: DataFrame, features: str, label: str, bins: Bins) -> DataFrame:
    """The rows of each partition, in their order, as blocks of PACKED_ROWS."""
    rows = df.select(
        F.spark_partition_id().alias("part"), F.col(label).cast("double").alias("label"),
        *values_of(df, features, len(bins.sizes)),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_block(table, bins) for table in in_blocks(batches, PACKED_ROWS))

    return rows.mapInArrow(pack, "part int, labels binary, lengths binary, cells binary")


def _block(table: pa.Table, bins: Bins) -> pa.RecordBatch:
    part, label, places, values = (c.chunk(0) for c in table.combine_chunks().columns)
    if label.null_count or values.null_count:
        raise ValueError("a row to fit has no label or no vector")
    labels, lengths = label.to_numpy(), values.value_lengths().to_numpy()
    place, value = places.flatten().to_numpy(), values.flatten().to_numpy()
    if not np.isin(labels, np.arange(bins.classes)).all():
        raise ValueError(f"a label isn't one of {bins.classes} classes")
    if not np.isfinite(value).all():
        raise ValueError("a vector holds NaN or infinity")
    found = np.empty(len(place), np.int64)
    binary = bins.binary[place]
    found[binary] = value[binary]
    if binary.any() and not 0 <= found[binary].min() <= found[binary].max() <= 1:
        raise ValueError("a binary feature is neither 0 nor 1")
    others = np.flatnonzero(~binary)
    others = others[np.argsort(place[others], kind="stable")]
    present, begins = np.unique(place[others], return_index=True)
    for f, own in zip(present, np.split(others, begins[1:])):
        found[own] = np.searchsorted(bins.thresholds[int(f)], value[own])
    found += bins.starts[place]
    kind = np.uint16 if bins.cells < 2**16 else np.int32
    parts = [labels.astype(np.int32), lengths.astype(np.int32), found.astype(kind)]
    return pa.RecordBatch.from_arrays(
        [part.slice(0, 1), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], schema=PACKED
    )


@dataclass
class Node:
    """A node with what its rows count up to by class; ``cut`` is the last bin that goes left."""

    counts: np.ndarray
    level: int
    impurity: float = -1.0
    gain: float = 0.0
    feature: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Pass:
    """What tasks need to count the rows of some nodes. Trees by number: features, cuts,
    children, and the place among the nodes to count or -1, of each of its nodes."""

    trees: dict[int, tuple[np.ndarray, ...]]
    used: np.ndarray
    nodes: int
    wanted: np.ndarray | None


class Poisson:
    """Counts drawn like Spark's bootstrap: by the row, 32 bits of a uniform number each."""

    def __init__(self, rate: float) -> None:
        chance, total, edges = math.exp(-rate), 0.0, []
        while (edge := round((total := total + chance) * 2**32)) < 2**32 and len(edges) < 250:
            edges.append(edge)
            chance *= rate / len(edges)
        self.edges = np.array(edges, np.uint64)
        low = np.searchsorted(self.edges, np.arange(2**16, dtype=np.uint64) << np.uint64(16), "right")
        high = np.searchsorted(self.edges, (np.arange(2**16, dtype=np.uint64) << np.uint64(16)) + np.uint64(2**16 - 1), "right")
        #: By the upper 16 bits; 255 where the lower ones tell.
        self.by_half = np.where(low == high, low, 255).astype(np.uint8)

    def draw(self, rng: np.random.Generator, shape: tuple[int, int]) -> np.ndarray:
        uniform = rng.integers(0, 2**32, shape, np.uint32)
        out = self.by_half[uniform >> 16]
        open_ = np.nonzero(out == 255)
        out[open_] = np.searchsorted(self.edges, uniform[open_].astype(np.uint64), "right")
        return out


def _add_block(block: dict, bins: Bins, step: Pass, weights: np.ndarray | None, sums: np.ndarray) -> None:
    """Add the counts of a block's rows by node, cell and class; the cell after the last counts them all."""
    labels, lengths = (np.frombuffer(block[c], np.int32).astype(np.int64) for c in ("labels", "lengths"))
    cells = np.frombuffer(block["cells"], np.uint16 if bins.cells < 2**16 else np.int32)
    n, first, one = len(labels), np.cumsum(lengths) - lengths, (bins.cells + 1) * bins.classes
    slots: list[tuple[np.ndarray | slice, np.ndarray]] = [(slice(None), labels + bins.cells * bins.classes)]
    binned = np.repeat(bins.zeros[step.used][:, None], n, axis=1)
    at = np.full(len(bins.sizes), -1)
    at[step.used] = np.arange(len(step.used))
    feature_of = np.repeat(np.arange(len(bins.sizes)), bins.sizes)
    for j in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > j)
        found = cells[first[rows] + j].astype(np.int64)
        slots.append((rows if len(rows) < n else slice(None), found * bins.classes + labels[rows]))
        feature = feature_of[found]
        asked = at[feature] >= 0
        binned[at[feature[asked]], rows[asked]] = (found - bins.starts[feature])[asked]
    size, every, binned = sum(len(c) for _, c in slots), np.arange(n), binned.ravel()
    index, share = np.empty(size, np.int64), np.empty(size) if weights is not None else None
    for tree, (features, cuts, lefts, rights, places, depth) in step.trees.items():
        row, node = at[features] * n, np.zeros(n, np.int64)
        for _ in range(depth):
            go_left = binned[row[node] + every] <= cuts[node]
            node = np.where(go_left, lefts[node], rights[node])
        # A tree's nodes to count stand in a row; the rows at others go to one more.
        asked = places >= 0
        begin, nodes = places[asked].min(), np.count_nonzero(asked)
        base = (np.where(asked, places - begin, nodes) * one)[node]
        own, to = None if weights is None else weights[tree].astype(float), 0
        for rows, cell in slots:
            np.add(base[rows], cell, out=index[to : to + len(cell)])
            if share is not None:
                share[to : to + len(cell)] = own[rows]
            to += len(cell)
        found = np.bincount(index, share, (nodes + 1) * one)
        sums[begin * one : (begin + nodes) * one] += found[: nodes * one]


def _sum(packed: DataFrame, bins: Bins, step: Pass, trees: int, rate: float | None, seed: int) -> np.ndarray:
    """Counts of the nodes' rows by node, cell and class, from one pass over the packed rows."""
    context, kind, parts = packed.sparkSession.sparkContext, "part int, counts binary", packed.rdd.getNumPartitions()
    sent, lots = context.broadcast((bins, step)), Poisson(rate) if rate is not None else None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, step = sent.value
        size, part, rng, sums = (bins.cells + 1) * bins.classes, -1, None, np.zeros(0)

        def row() -> pa.RecordBatch:
            counts = sums.reshape(-1, bins.classes)
            counts = counts if step.wanted is None else counts[step.wanted]
            return pa.RecordBatch.from_pylist([{"part": part, "counts": counts.tobytes()}], schema=SUMMED)

        for batch in batches:
            for block in batch.to_pylist():
                if block["part"] != part:
                    if rng is not None:
                        yield row()
                    part, sums = block["part"], np.zeros(step.nodes * size)
                    rng = np.random.Generator(np.random.SFC64([seed % 2**64, part]))
                drawn = None if lots is None else lots.draw(rng, (trees, len(block["labels"]) // 4))
                _add_block(block, bins, step, drawn, sums)
        if rng is not None:
            yield row()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"])
                total, part = counts.copy() if total is None else total + counts, row["part"]
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "counts": total.tobytes()}], schema=SUMMED)

    found = in_few_tasks(packed).mapInArrow(add, kind)
    if parts > DIRECT_SUMS:
        found = found.repartition(math.isqrt(parts), "part").mapInArrow(merge, kind)
    summed = sum(np.frombuffer(r["counts"]) for r in found.collect()).reshape(-1, bins.classes)
    sent.destroy()
    counts = np.zeros((step.nodes * (bins.cells + 1), bins.classes))
    counts[slice(None) if step.wanted is None else step.wanted] = summed
    return counts.reshape(step.nodes, bins.cells + 1, bins.classes)


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    out = np.ones(total.shape)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / np.maximum(total, 1.0)
        out -= share * share
    return np.where(total == 0, 0.0, out)


def _split(node: Node, counts: np.ndarray, features: np.ndarray, bins: Bins, rules: tuple[float, float, float]) -> None:
    """Settle the best split of a node, the first of equally good ones in the order of
    ``features``, or none. ``counts`` are those of its rows by cell and class."""
    total, seen = counts[-1], counts[:-1].copy()
    seen[bins.starts + bins.zeros] += total - np.add.reduceat(seen, bins.starts, axis=0)
    along = np.vstack([np.zeros(bins.classes), np.cumsum(seen, axis=0)])
    candidates = np.concatenate([np.arange(s, s + k - 1) for s, k in zip(bins.starts[features], bins.sizes[features])])
    owner = np.repeat(features, bins.sizes[features] - 1)
    node.counts, node.gain = total, -math.inf
    if not len(candidates):
        return
    impurity = float(_gini(total, total.sum()))
    left = along[candidates + 1] - along[bins.starts[owner]]
    right = total - left
    nl, nr = left.sum(axis=1), right.sum(axis=1)
    share = nl + nr
    gain = impurity - nl / share * _gini(left, nl) - nr / share * _gini(right, nr)
    least, weight, info = rules
    ok = (nl >= least) & (nr >= least) & (nl >= weight) & (nr >= weight) & (gain >= info)
    gain = np.where(ok, gain, -math.inf)
    best = int(np.argmax(gain))
    if ok[best]:
        node.impurity, node.gain = impurity, float(gain[best])
        node.feature, node.cut = int(owner[best]), int(candidates[best] - bins.starts[owner[best]])
        node.left, node.right = (Node(side[best], node.level + 1) for side in (left, right))


def _listed(root: Node) -> list[Node]:
    out = [root]
    for node in out:
        out += [c for c in (node.left, node.right) if c is not None]
    return out


def _pass(group: dict[int, list[tuple[Node, np.ndarray]]], roots: list[Node], bins: Bins) -> Pass:
    order = {id(node): k for k, (node, _) in enumerate(x for found in group.values() for x in found)}
    trees, used = {}, {0}
    for tree in group:
        nodes = _listed(roots[tree])
        at = {id(node): k for k, node in enumerate(nodes)}
        used |= {node.feature for node in nodes if node.left}
        trees[tree] = (
            *(np.array(x) for x in zip(*(
                (max(n.feature, 0), n.cut, at[id(n.left or n)], at[id(n.right or n)], order.get(id(n), -1)) for n in nodes
            ))),
            max(n.level for n in nodes),
        )
    wanted = None
    if bins.per_node < len(bins.sizes):
        asked = []
        for k, features in enumerate(f for found in group.values() for _, f in found):
            cells = [np.arange(bins.starts[f], bins.starts[f] + bins.sizes[f]) for f in np.sort(features)]
            asked.append(k * (bins.cells + 1) + np.concatenate([*cells, [bins.cells]]))
        wanted = np.concatenate(asked)
    return Pass(trees, np.array(sorted(used)), len(order), wanted)


class _Subsets:
    """The features drawn for one node after another, and the order in which a group's
    trees are gone through: both as in Spark's fit, whose generator and map are asked."""

    def __init__(self, context, bins: Bins, seed: int) -> None:
        jvm = context._jvm
        self.jvm, self.bins, self.rng = jvm, bins, jvm.java.util.Random(seed)
        self.places = getattr(jvm.scala.collection.immutable, "Range$Exclusive")(0, len(bins.sizes), 1)
        self.ints = getattr(getattr(jvm.scala.reflect, "ClassTag$"), "MODULE$").Int()
        self.nothing = getattr(getattr(jvm.scala.collection.immutable, "HashMap$"), "MODULE$").empty()

    def draw(self) -> np.ndarray:
        if self.bins.per_node == len(self.bins.sizes):
            return np.arange(self.bins.per_node)
        sampling = getattr(getattr(self.jvm.org.apache.spark.util.random, "SamplingUtils$"), "MODULE$")
        drawn = sampling.reservoirSampleAndCount(
            self.places.iterator(), self.bins.per_node, self.rng.nextLong(), self.ints
        )._1()
        return np.array([int(x) for x in self.jvm.java.util.Arrays.toString(drawn)[1:-1].split(",")])

    def order(self, trees: list[int]) -> list[int]:
        if len(trees) <= 4:
            return sorted(trees, key=lambda t: (t % 16, t))
        held = self.nothing
        for tree in trees:
            held = held.updated(tree, tree)
        return [int(x) for x in held.keysIterator().mkString(",").split(",")]


def _fitted(estimator, dataset: DataFrame, bins: Bins, trees: int, rate: float | None) -> list[Node]:
    """The roots of the trees, grown by groups of nodes that are counted together."""
    packed = _packed(dataset, estimator.getFeaturesCol(), estimator.getLabelCol(), bins)
    packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _grown(estimator, packed, bins, trees, rate)
    finally:
        packed.unpersist()


def _grown(estimator, packed: DataFrame, bins: Bins, trees: int, rate: float | None) -> list[Node]:
    seed, deepest = estimator.getSeed(), estimator.getMaxDepth()
    weight = estimator.getMinWeightFractionPerNode() * bins.rows
    rules = (estimator.getMinInstancesPerNode(), weight, estimator.getMinInfoGain())
    roots = [Node(np.zeros(bins.classes), 0) for _ in range(trees)]
    subsets = _Subsets(packed.sparkSession.sparkContext, bins, seed)
    most = max(1, (estimator.getMaxMemoryInMB() << 20) // (8 * (bins.cells + 1) * bins.classes))
    stack = list(enumerate(roots))
    while stack:
        group: dict[int, list[tuple[Node, np.ndarray]]] = {}
        for _ in range(min(most, len(stack))):
            tree, node = stack.pop()
            group.setdefault(tree, []).append((node, subsets.draw()))
        counts = iter(_sum(packed, bins, _pass(group, roots, bins), trees, rate, seed))
        for found in group.values():
            for node, features in found:
                _split(node, next(counts), features, bins, rules)
        for tree in subsets.order(list(group)):
            for node, _ in group[tree]:
                if node.gain <= 0 or node.level == deepest:
                    node.left = node.right = None
                for child in (c for c in (node.left, node.right) if c is not None):
                    child.impurity = float(_gini(child.counts, child.counts.sum()))
                    if child.level < deepest and child.impurity >= EPSILON:
                        stack.append((tree, child))
    return roots


def _java_tree(root: Node, bins: Bins, uid: str | None = None):
    """Spark's model of a tree; two leaves of one prediction are one leaf, as there."""
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    ml, impurity = context._jvm.org.apache.spark.ml, context._jvm.org.apache.spark.mllib.tree.impurity

    def doubles(values):
        out = context._gateway.new_array(context._jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def built(node: Node):
        guess = float(np.argmax(node.counts))
        stats = impurity.GiniCalculator(doubles(node.counts), int(node.counts.sum()))
        if node.left is not None:
            (left, of_left), (right, of_right) = built(node.left), built(node.right)
            if of_left is None or of_right is None or of_left != of_right:
                if bins.binary[node.feature]:
                    split = ml.tree.CategoricalSplit(node.feature, doubles([0.0]), 2)
                else:
                    split = ml.tree.ContinuousSplit(node.feature, float(bins.thresholds[node.feature][node.cut]))
                return ml.tree.InternalNode(guess, node.impurity, node.gain, left, right, split, stats), None
        return ml.tree.LeafNode(guess, node.impurity, stats), guess

    model = ml.classification.DecisionTreeClassificationModel
    args = (built(root)[0], len(bins.sizes), bins.classes)
    return model(uid, *args) if uid else model(*args)
