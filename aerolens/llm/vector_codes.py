"""Vector code compression by Lloyd's rounds over cover trees (operator 12).

A vector is cut into consecutive parts, and each part is replaced by the number
of the nearest entry of its position's codebook. Components are whole numbers
(``floor(scale * x)``), so sums, distances and ties are exact and the result
does not depend on how the rows are dealt out.

A task takes some thousand vectors at a time and builds a cover tree for each
part position: a node of level i covers its points within 2^i of its centre, its
children cover them within 2^(i-1), their centres are further apart than that,
and the first child has the node's own centre. A node keeps the number and the
sum of all points below it. The trees are written once to the shared checkpoint
folder, and each round goes down them from the roots: by the triangle inequality
a node whose second nearest entry is further off than the nearest one by more
than twice the node's radius is assigned with all its points through its sum;
only ambiguous nodes go on to their children, and ambiguous leaves compare their
points exactly. Tasks hand on sums for each entry, and the driver holds
codebooks alone (``entries`` times one vector).

Rows whose vector is null or holds null or non-finite components are dropped.
Part limits are ``floor(k * length / parts)``. Vectors not of the most frequent
length (ties: the longer one) stay with null code and error. The first codebook
is taken from the smallest ids; a null id counts as larger than any other, ties
are broken by the vector, repeated rows count each, and with fewer rows than
entries the codebook is that much smaller. Equal distances go to the lower
index; of equal entries the lower one takes all and the others stay unused.
Components are held at 2^26 at most. Equal labels share ``label_error``, null
ones too. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import checkpoint, column, give_back

#: Largest component; distances and sums of a task then fit a long.
LARGEST = 1 << 26
#: Components of the vectors that share a tree for each part.
TREE_COMPONENTS = 1 << 19
#: Points up to which a node is a leaf.
LEAF = 12
#: Nodes or points compared with a codebook at a time.
SLAB = 4096
#: Rows of sums by label that are broadcast, and parts that hot labels' rows go to beyond.
BROADCAST_LABELS, SALTS = 50_000, 32

NODE = np.dtype([
    ("first", "<i4"), ("last", "<i4"), ("centre", "<i4"), ("part", "<i4"), ("child", "<i4"), ("children", "<i4"),
    ("radius", "<f8"),
])


# ------------------------------------------------------------------------ trees


@dataclass
class Trees:
    """One cover tree for each part: points in tree order, nodes, and each node's sum."""

    points: np.ndarray  # (points, width)
    order: np.ndarray  # number of each point before: part by part, vector by vector
    nodes: np.ndarray
    sums: np.ndarray  # (nodes, width)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def _heads(values: np.ndarray) -> np.ndarray:
    """Positions at which a sorted, non-empty array changes its value, with the first."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def _split(points: np.ndarray, owner: np.ndarray, centre: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For points sorted by ``owner`` (0, 1, ...) the child that covers each, and
    the children's centres (positions), owner by owner: the first is the owner's
    own centre, each further one the first point that none covers yet."""
    child, centres = np.full(len(points), -1), []
    left, pick, made = np.arange(len(points)), centre, 0
    who = np.arange(len(centre))
    while len(left):
        number = np.full(len(centre), -1)
        number[who] = made + np.arange(len(who))
        centres.append(np.stack([who, pick], axis=1))
        made += len(who)
        own = owner[left]
        at = np.zeros(len(centre), np.int64)
        at[who] = pick
        near = _squares(points[left], points[at[own]]) <= reach[own]
        child[left[near]] = number[own[near]]
        left = left[~near]
        if len(left):
            head = _heads(owner[left])
            who, pick = owner[left[head]], left[head]
    found = np.concatenate(centres)
    order = np.argsort(found[:, 0], kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[child], found[order, 1]


def cover_trees(points: np.ndarray, part: np.ndarray) -> Trees:
    """A cover tree for the points of each part, all parts level by level."""
    order = np.argsort(part, kind="stable")
    points, part = points[order], part[order]
    head = _heads(part)
    first, last = head, np.append(head[1:], len(part))
    levels, made = [], 0
    level = np.zeros(len(head), NODE)
    level["first"], level["last"], level["centre"], level["part"] = first, last, first, part[head]
    while True:
        span = level["last"] - level["first"]
        at = np.repeat(level["first"] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        off = _squares(points[at], points[np.repeat(level["centre"], span)])
        far = np.maximum.reduceat(off, np.cumsum(span) - span)
        level["radius"] = np.sqrt(far.astype(np.float64))
        levels.append(level)
        made += len(level)
        open_nodes = np.flatnonzero((far > 0) & (span > LEAF))
        if not len(open_nodes):
            break
        parents = level[open_nodes]
        span = span[open_nodes]
        at = np.repeat(parents["first"] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        owner = np.repeat(np.arange(len(parents)), span)
        place = np.full(len(points), -1)
        place[at] = np.arange(len(at))
        # Of level i (radius up to 2^i), covered within 2^(i-1).
        reach = 4.0 ** (np.ceil(np.log2(parents["radius"]) - 1e-9) - 1)
        child, centre = _split(points[at], owner, place[parents["centre"]], reach)
        sort = np.argsort(child, kind="stable")
        moved = np.empty(len(at), np.int64)
        moved[sort] = np.arange(len(at))
        points[at], order[at] = points[at][sort], order[at][sort]
        many = np.bincount(child, minlength=len(centre))
        begin = np.cumsum(many) - many
        lower = np.zeros(len(centre), NODE)
        lower["first"], lower["last"] = at[begin], at[begin] + many
        lower["centre"] = at[moved[centre]]
        of = owner[sort][begin]
        lower["part"] = parents["part"][of]
        count = np.bincount(of, minlength=len(parents))
        level["child"][open_nodes] = made + np.cumsum(count) - count
        level["children"][open_nodes] = count
        # Centres above may have moved inside their range.
        where = np.arange(len(points))
        where[at] = at[moved]
        for upper in levels:
            upper["centre"] = where[upper["centre"]]
        level = lower
    nodes = np.concatenate(levels)
    total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
    return Trees(points, order, nodes, total[nodes["last"]] - total[nodes["first"]])


# ------------------------------------------------------------------- assignment


class Books:
    """Codebooks with their distinct entries, the lowest index of each."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries  # for each part (entries, width)
        distinct = [np.sort(np.unique(e, axis=0, return_index=True)[1]) for e in entries]
        most = max(len(x) for x in distinct)
        # Beyond a part's own ones, the first entry again: it never wins over itself.
        self.index = np.stack([np.concatenate([x, np.repeat(x[:1], most - len(x))]) for x in distinct])
        self.there = np.stack([np.arange(most) < len(x) for x in distinct])
        self.values = np.stack([e[i] for e, i in zip(entries, self.index, strict=True)])

    def nearest(self, points: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest entry, and distances to it and to the next one."""
        index, one, two = (np.zeros(len(points), t) for t in (np.int64, np.float64, np.float64))
        for at in range(0, len(points), SLAB):
            cut = slice(at, at + SLAB)
            own = part[cut]
            off = _squares(points[cut][:, None, :], self.values[own])
            off[~self.there[own]] = np.iinfo(np.int64).max
            rows, best = np.arange(len(own)), off.argmin(axis=1)
            index[cut], one[cut] = self.index[own, best], np.sqrt(off[rows, best].astype(np.float64))
            off[rows, best] = np.iinfo(np.int64).max
            two[cut] = np.sqrt(off.min(axis=1).astype(np.float64))
        return index, one, two


def assign(trees: Trees, books: Books) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entry of every point in tree order, and each entry's number and sum of points."""
    parts, most, width = len(books.entries), max(map(len, books.entries)), trees.points.shape[1]
    code = np.zeros(len(trees.points), np.int64)
    number, total = np.zeros(parts * most, np.int64), np.zeros((parts * most, width), np.int64)
    front = np.arange(len(np.unique(trees.nodes["part"]))) if len(trees.nodes) else np.zeros(0, np.int64)
    while len(front):
        node = trees.nodes[front]
        index, one, two = books.nearest(trees.points[node["centre"]], node["part"])
        # The margin is far more than the rounding of the roots.
        sure = (node["radius"] == 0) | (two - one > 2 * node["radius"] + 1e-6 * (1 + one))
        place = node["part"] * most + index
        span = node["last"] - node["first"]
        np.add.at(number, place[sure], span[sure])
        np.add.at(total, place[sure], trees.sums[front[sure]])
        _paint(code, node[sure], index[sure])
        leaf = ~sure & (node["children"] == 0)
        if leaf.any():
            many = span[leaf]
            at = np.repeat(node["first"][leaf] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            part = np.repeat(node["part"][leaf], many).astype(np.int64)
            code[at], _, _ = books.nearest(trees.points[at], part)
            np.add.at(number, part * most + code[at], 1)
            np.add.at(total, part * most + code[at], trees.points[at])
        down = node[~sure & ~leaf]
        many = down["children"]
        front = np.repeat(down["child"] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return code, number, total


def _paint(code: np.ndarray, node: np.ndarray, index: np.ndarray) -> None:
    many = node["last"] - node["first"]
    at = np.repeat(node["first"] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    code[at] = np.repeat(index, many)


# --------------------------------------------------------------------- operator


def limits(length: int, parts: int) -> list[int]:
    return [k * length // parts for k in range(parts + 1)]


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(parts, vectors, width): the parts, filled up with zeros to one width."""
    edge = limits(vectors.shape[1], parts)
    width = max(1, *np.diff(edge))
    out = np.zeros((parts, len(vectors), width), np.int64)
    for k in range(parts):
        out[k, :, : edge[k + 1] - edge[k]] = vectors[:, edge[k] : edge[k + 1]]
    return out


def _whole(vectors: list[np.ndarray] | np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(np.asarray(vectors, np.float64) * scale), -LARGEST, LARGEST).astype(np.int64)


TREES = "vec_ids array<long>, labels array<string>, points binary, order binary, nodes binary, sums binary"


def _grown(rows: DataFrame, length: int, parts: int, scale: float) -> DataFrame:
    """The vectors of ``rows`` as trees, some thousands to a row."""
    most = max(64, TREE_COMPONENTS // max(length, 1))

    def tree(lots: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(lots)
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        points = _cut(_whole(flat.reshape(table.num_rows, length), scale), parts)
        grown = cover_trees(points.reshape(-1, points.shape[2]), np.repeat(np.arange(parts), table.num_rows))
        held = [grown.points.astype("<i4"), grown.order.astype("<i4"), grown.nodes, grown.sums.astype("<i8")]
        return pa.RecordBatch.from_arrays(
            [pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([table.column("label").to_pylist()], pa.list_(pa.string()))]
            + [pa.array([x.tobytes()], pa.binary()) for x in held],
            ["vec_ids", "labels", "points", "order", "nodes", "sums"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots, held = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, most - held)
                lots.append(part)
                held, at = held + part.num_rows, at + part.num_rows
                if held == most:
                    yield tree(lots)
                    lots, held = [], 0
        if held:
            yield tree(lots)
        give_back()

    return rows.mapInArrow(run, TREES)


def _read(batch: pa.RecordBatch, width: int) -> Iterator[tuple[Trees, pa.Array, pa.Array]]:
    for k in range(batch.num_rows):
        points, order, nodes, sums = (batch.column(c)[k].as_py() for c in range(2, 6))
        yield Trees(
            np.frombuffer(points, "<i4").reshape(-1, width).astype(np.int64),
            np.frombuffer(order, "<i4"), np.frombuffer(nodes, NODE), np.frombuffer(sums, "<i8").reshape(-1, width),
        ), batch.column(0)[k].values, batch.column(1)[k].values


def _moved(trees: DataFrame, entries: list[np.ndarray]) -> list[np.ndarray]:
    """A Lloyd round: each entry becomes the floor of the mean of its parts."""
    parts, most, width = len(entries), len(entries[0]), entries[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Books(entries)
        held = np.zeros((parts * most, width + 1), np.int64)
        for batch in batches:
            for tree, _, _ in _read(batch, width):
                _, number, total = assign(tree, books)
                held[:, 0] += number
                held[:, 1:] += total
        used = np.flatnonzero(np.repeat(held[:, 0] > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held.ravel()[used])], ["slot", "value"])
        give_back()

    sums = trees.mapInArrow(run, "slot long, value long").groupBy("slot")
    found = sums.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    values = {r["slot"]: int(r["value"]) for r in found}  # entries times components
    out = [e.copy() for e in entries]
    for k in range(parts):
        for e in range(most):
            slot = (k * most + e) * (width + 1)
            if slot in values:
                out[k][e] = [values[slot + 1 + j] // values[slot] for j in range(width)]
    return out


def _coded(trees: DataFrame, entries: list[np.ndarray]) -> DataFrame:
    parts, width = len(entries), entries[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Books(entries)
        values = np.stack(entries)
        for batch in batches:
            for tree, ids, labels in _read(batch, width):
                code, _, _ = assign(tree, books)
                part = tree.order // len(ids)
                off = _squares(tree.points, values[part, code])
                own = np.empty((2, len(code)), np.int64)
                own[:, tree.order] = code, off
                codes = own[0].reshape(parts, -1).T.astype(np.uint8)
                text = [row.tobytes().hex() for row in np.ascontiguousarray(codes)]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(text, pa.string()), pa.array(own[1].reshape(parts, -1).sum(axis=0))],
                    ["vec_id", "label", "code", "error"],
                )
        give_back()

    return trees.mapInArrow(run, "vec_id long, label string, code string, error long")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``. Sums for each label are broadcast if they are few by
    count; else labels are salted, so that no task gets all rows of one."""
    sums = checkpoint(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(
            F.broadcast(sums.withColumnRenamed("label", "_label")), F.col("label").eqNullSafe(F.col("_label")), "left"
        ).drop("_label")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = sums.select(F.col("label").alias("_label"), "label_error", salts.alias("_salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("salt") == F.col("_salt"))
    return salted.join(sums, same, "left").drop("salt", "_salt", "_label")


@dataclass
class Compressed:
    """Codes (vec_id, code, error, label_error) and, for each part, its codebook."""

    codes: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        said = ",".join(str(x) for book in self.codebooks for entry in book.tolist() for x in entry)
        return hashlib.sha256(said.encode()).hexdigest()


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine


def compress(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> Compressed:
    """Codes of all vectors and the codebooks after ``rounds``; at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    rows = df.select(
        column(df, id_col).cast("long").alias("vec_id"),
        column(df, label_col).cast("string").alias("label"),
        column(df, vector_col).cast("array<double>").alias("vector"),
    )
    rows = rows.where(_usable(F.col("vector"))).withColumn("length", F.size("vector"))
    usual = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    length = usual["length"] if usual else 0
    fit = rows.where(F.col("length") == length)
    seeds = fit.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    if not seeds:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(empty.withColumn("label_error", F.col("error")), [])
    books = list(_cut(_whole([r["vector"] for r in seeds], scale), parts))
    trees = checkpoint(_grown(fit.select("vec_id", "label", "vector"), length, parts, scale))
    for _ in range(rounds):
        books = _moved(trees, books)
    coded = _coded(trees, books)
    odd = rows.where(F.col("length") != length)
    if not odd.isEmpty():
        nothing = (F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        coded = coded.union(odd.select("vec_id", "label", *nothing))
    codes = _with_label_errors(checkpoint(coded)).select("vec_id", "code", "error", "label_error")
    edge = limits(length, parts)
    return Compressed(codes, [b[:, : edge[k + 1] - edge[k]] for k, b in enumerate(books)])
