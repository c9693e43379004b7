"""Near-duplicate embeddings by a forest of random projection trees (operator 7).

Vectors are compared within a label. Every tree splits them again and again at
the median of their projections on a random direction; vectors near a split go
to both sides (spill), and vectors of one leaf are compared with each other.
Many trees find a pair that one tree parts; their number follows the depth. Links are pairs with a cosine, in
double precision, of at least ``least``.

The upper splits of a label too large for one task are fitted on a bounded
sample of its vectors (``sample_rows``) and broadcast; its vectors are dealt out
by them, and the splitting goes on in the tasks, on each part's own medians, down to ``leaf_rows``, as long as a split
spares comparisons. Where it doesn't, as all vectors are close together, and in
parts too large for one task, every two blocks of vectors meet in a place of
their own. Single pairs never leave a task: it gives for each vector how many it
links with, and links that hold the linked ones together. For that each vector
carries the leaves that hold it, in all trees; a pair counts in the smallest one
that it shares. Equal vectors of a label collapse first and count as many.

Recall against brute force is 1.0 on the test tables (tests/llm); 0.9 is the
least accepted.

Vectors that are null, empty, zero or hold a null or non-finite component, and
those whose label is null, link with nothing. Vectors of different lengths
aren't compared. Null ids count as larger than any other. Rows sharing an id
are separate vectors; each row gives a row. An empty table gives no rows, and
other columns are not read. Vectors at one end of a split by ties go to the same
side; pairs at the threshold exactly are linked.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import NO_ID, checkpoint, column, components

#: Spill, in standard deviations (see _margin).
SPILL = 0.5
#: Share of the pairs at the threshold that all trees together may part.
PARTED = 1e-4
#: A split must leave less than this share of a node's comparisons.
WORTH = 0.8
#: Vectors of a part that one task takes on, on average; twice as many at most.
PART_ROWS = 20_000
#: Vectors of a leaf that one task compares with each other.
BLOCK_ROWS = 4000
#: Vectors compared with as many others in one matrix product.
TILE = 1024
CELLS = {"node": pa.int64(), "place": pa.int64(), "own": pa.list_(pa.int64()), "blocks": pa.int32()}
SPLITS = {"part": pa.int64(), "width": pa.int32(), "tree": pa.int32(), "node": pa.int32(), "at": pa.float64()}


def _direction(size: int, *path: int) -> np.ndarray:
    found = np.random.default_rng([20240607, size, *path]).standard_normal(size)
    return found / np.linalg.norm(found)


def _margin(size: int, least: float) -> float:
    """Half the width of the zone around a split whose vectors go both ways:
    one standard deviation of how far linked vectors' projections lie apart."""
    return SPILL * math.sqrt(2 - 2 * least) / math.sqrt(size)


def _held(least: float) -> float:
    """Share of a node's rows on each side, for vectors spread evenly."""
    return min(0.9, 0.5 + SPILL * math.sqrt(2 - 2 * least) / math.sqrt(2 * math.pi))


def trees_for(rows: int, leaf_rows: int, least: float) -> int:
    """How many trees it takes for vectors spread evenly: with more rows a tree
    has more levels, each of which may part a pair, and more trees make up for
    it, so that recall is the same at every size."""
    apart = math.sqrt(2 - 2 * least)  # spread of a pair's projections against that of all
    beyond = 2 * SPILL
    tail = 0.5 * math.erfc(beyond / math.sqrt(2))
    density = math.exp(-beyond * beyond / 2) / math.sqrt(2 * math.pi)
    parted = min(0.9, apart * 2 * (density - beyond * tail) / math.sqrt(2 * math.pi))
    levels = max(1.0, math.log(max(1, rows / leaf_rows)) / -math.log(_held(least)))
    return math.ceil(math.log(PARTED) / math.log(1 - (1 - parted) ** levels))


def _pays(low: int, high: int, rows: int) -> bool:
    """Whether a split that sends ``low`` and ``high`` rows to its sides spares
    comparisons. Among vectors close together it doesn't: most go both ways."""
    return low * low + high * high < WORTH * rows * rows


def fit(sample: np.ndarray, depth: int, count: int, margin: float) -> list[dict[int, float]]:
    """For each tree the split value of each upper node (numbered as a heap)."""
    trees = []
    for tree in range(count):
        splits: dict[int, float] = {}
        todo = [(1, np.arange(len(sample)))]
        while todo:
            node, own = todo.pop()
            if node >> depth or len(own) < 2:
                continue
            along = sample[own] @ _direction(sample.shape[1], tree, node)
            middle = float(np.median(along))
            if not _pays(int((along < middle + margin).sum()), int((along >= middle - margin).sum()), len(own)):
                continue
            splits[node] = middle
            todo += [(2 * node, own[along < middle]), (2 * node + 1, own[along >= middle])]
        trees.append(splits)
    return trees


def parts_of(unit: np.ndarray, tree: int, splits: dict[int, float], margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """Upper leaves and the rows that fall into each."""
    todo = [(1, np.arange(len(unit)))]
    while todo:
        node, rows = todo.pop()
        if node not in splits or not len(rows):
            if len(rows):
                yield node, rows
            continue
        along = unit[rows] @ _direction(unit.shape[1], tree, node)
        todo.append((2 * node, rows[along < splits[node] + margin]))
        todo.append((2 * node + 1, rows[along >= splits[node] - margin]))


def leaves(unit: np.ndarray, tree: int, least: float, leaf_rows: int) -> Iterator[np.ndarray]:
    """Rows (positions) of each leaf of one tree over these vectors. Leaves
    that no split would make cheaper stay larger than ``leaf_rows``."""
    margin = _margin(unit.shape[1], least)
    todo = [(1, np.arange(len(unit)))]
    while todo:
        node, rows = todo.pop()
        for attempt in range(3 if len(rows) > leaf_rows else 0):
            along = unit[rows] @ _direction(unit.shape[1], tree, node, 1 + attempt)
            middle = float(np.median(along))
            low, high = rows[along < middle + margin], rows[along >= middle - margin]
            if _pays(len(low), len(high), len(rows)):
                todo += [(2 * node % (1 << 62), low), ((2 * node + 1) % (1 << 62), high)]
                break
        else:
            yield rows


def _number(*parts: int) -> int:
    found = hashlib.blake2b(struct.pack(f"{len(parts)}q", *parts), digest_size=8).digest()
    return int.from_bytes(found, "little", signed=True)


class _Found:
    """What comparisons find, without the single pairs: how many rows each
    vector links with, and enough links to join those that belong together.

    A pair counts in the smallest cell that holds both, and nowhere else."""

    def __init__(self, unit: np.ndarray, many: np.ndarray, cells: list[np.ndarray], least: float):
        self.unit, self.many, self.cells, self.least = unit, many, cells, least
        self.others = np.zeros(len(unit), np.int64)
        self.parent = list(range(len(unit)))
        self.links: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def compare(self, x: np.ndarray, y: np.ndarray, cell: int) -> None:
        """Rows ``x`` with rows ``y`` of a cell, tile by tile; ``y`` is ``x`` or has no row of it."""
        for a in range(0, len(x), TILE):
            for b in range(a if y is x else 0, len(y), TILE):
                self._tile(x[a : a + TILE], y[b : b + TILE], y is x and a == b, cell)

    def _tile(self, x: np.ndarray, y: np.ndarray, same: bool, cell: int) -> None:
        if self._all_before(x if same else np.concatenate((x, y)), cell):
            return
        close = self.unit[x] @ self.unit[y].T >= self.least
        if same:
            np.fill_diagonal(close, False)
        in_x, in_y = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        if not len(in_x):
            return
        x, y, close = x[in_x], y[in_y], close[np.ix_(in_x, in_y)]
        self._join(x, y, close)
        close &= ~self._before(x, y, cell)
        self.others[x] += close @ self.many[y]
        if not same:
            self.others[y] += close.T @ self.many[x]

    def _smaller(self, row: int, cell: int) -> np.ndarray:
        held = self.cells[row]
        return held[held < cell]

    def _all_before(self, rows: np.ndarray, cell: int) -> bool:
        """Whether a smaller cell holds all these rows."""
        shared = self._smaller(rows[0], cell)
        for row in rows[1:]:
            if not len(shared):
                break
            shared = shared[np.isin(shared, self.cells[row])]
        return bool(len(shared))

    def _before(self, x: np.ndarray, y: np.ndarray, cell: int) -> np.ndarray:
        """Which pairs a smaller cell holds."""
        lots = [[self._smaller(row, cell) for row in rows] for rows in (x, y)]
        flat = [np.concatenate(lot) for lot in lots]
        owner = [np.repeat(np.arange(len(lot)), [len(h) for h in lot]) for lot in lots]
        both = np.intersect1d(*flat)
        met = np.zeros((len(x), len(y)), bool)
        for first in range(0, len(both), TILE):
            some = both[first : first + TILE]
            sides = []
            for rows, ids, own in zip((x, y), flat, owner, strict=True):
                at = np.minimum(np.searchsorted(some, ids), len(some) - 1)
                hit = some[at] == ids
                side = np.zeros((len(rows), len(some)), np.float32)
                side[own[hit], at[hit]] = 1
                sides.append(side)
            met |= sides[0] @ sides[1].T > 0
        return met

    def _join(self, x: np.ndarray, y: np.ndarray, close: np.ndarray) -> None:
        while True:
            roots = [np.array([self._root(int(r)) for r in rows]) for rows in (x, y)]
            apart = close & (roots[0][:, None] != roots[1][None, :])
            rows = np.flatnonzero(apart.any(axis=1))
            if not len(rows):
                return
            for r, t in zip(x[rows].tolist(), y[apart[rows].argmax(axis=1)].tolist(), strict=True):
                one, two = self._root(r), self._root(t)
                if one != two:
                    self.parent[max(one, two)] = min(one, two)
                    self.links.append((r, t))


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def close_vectors(
    df: DataFrame,
    least: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    leaf_rows: int = 256,
    sample_rows: int = 20_000,
) -> DataFrame:
    """vec_id, n_links, component_id and kept, for every row of ``df``."""
    rows = df.select(
        column(df, id_col).cast("long").alias("vec_id"),
        column(df, vector_col).cast("array<double>").alias("vector"),
        column(df, label_col).alias("label"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0)
    rows = rows.select(
        "vec_id",
        F.coalesce("vec_id", F.lit(NO_ID)).alias("rid"),
        F.when(sound, F.xxhash64("label", F.transform("vector", lambda x: x + F.lit(0.0)))).alias("node"),
        F.xxhash64("label").alias("part"),
        F.size("vector").alias("width"),
        "vector",
    )
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("rid").alias("rid"),
        F.count("*").alias("many"),
        F.first("part").alias("part"),
        F.first("width").alias("width"),
        F.first("vector").alias("vector"),
    )
    nodes = checkpoint(nodes)
    found = checkpoint(_found(nodes, least, leaf_rows, sample_rows))
    linked = found.where("b is null").groupBy("a").agg(F.sum("others").alias("others"))
    joined = components(found.where("b is not null"))
    of_node = nodes.join(linked, nodes["node"] == linked["a"], "left").join(
        joined, nodes["node"] == joined["id"], "left"
    )
    of_node = of_node.select(
        "node",
        "rid",
        (F.col("many") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    smallest = of_node.groupBy("component").agg(F.min("rid").alias("least"))
    of_node = of_node.join(smallest, "component").select("node", "n_links", "least")
    result = rows.select("vec_id", "rid", "node").join(of_node, "node", "left")
    component = F.coalesce("least", "rid")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(component != NO_ID, component).alias("component_id"),
        (component == F.col("rid")).alias("kept"),
    )


def _upper_splits(nodes: DataFrame, by_part: DataFrame, count: int, least: float, sample_rows: int) -> DataFrame:
    """(part, width, tree, node, at): upper splits of labels too large for one
    task, each fitted on a sample of its own."""
    large = by_part.where(F.col("n") > PART_ROWS)
    share = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1_000_000)) / 1e6
    sample = nodes.join(large, ["part", "width"]).where(share * F.col("n") < sample_rows)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part, width, n = (table.column(c)[0].as_py() for c in ("part", "width", "n"))
        order = np.argsort(table.column("node").to_numpy())
        unit = _unit(_matrix(table.column("vector").combine_chunks()))[order]
        depth = math.ceil(math.log(n / PART_ROWS) / -math.log(_held(least)))
        depth = min(depth, int(math.log2(max(1, len(unit) / 64))))
        found = [
            (part, width, tree, node, at)
            for tree, splits in enumerate(fit(unit, depth, count, _margin(width, least)))
            for node, at in splits.items()
        ]
        columns = zip(*found, strict=True) if found else ((),) * len(SPLITS)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, SPLITS.values(), strict=True)], list(SPLITS))

    return sample.select("part", "width", "n", "node", "vector").groupBy("part", "width").applyInArrow(
        run, "part long, width int, tree int, node int, at double"
    )


def _found(nodes: DataFrame, least: float, leaf_rows: int, sample_rows: int) -> DataFrame:
    """(a, null, others): rows that node a links with, to be summed up; and
    (a, b, null): links that join what belongs together."""
    by_part = nodes.groupBy("part", "width").agg(F.count("*").alias("n"))
    largest = by_part.agg(F.max("n")).first()[0] or 0
    count = trees_for(largest, leaf_rows, least)
    trees: dict[tuple[int, int], list[dict[int, float]]] = {}
    if largest > PART_ROWS:
        for r in _upper_splits(nodes, by_part, count, least, sample_rows).collect():
            fitted = trees.setdefault((r["part"], r["width"]), [{} for _ in range(count)])
            fitted[r["tree"]][r["node"]] = r["at"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            keys = list(zip(*(batch.column(at(c)).to_pylist() for c in ("part", "width")), strict=True))
            lots = []
            whole = [k for k, key in enumerate(keys) if key not in trees]
            if whole:  # one task takes on all trees of a label
                number = {key: _number(*key, -1, 1) for key in set(keys)}
                lots.append(([number[keys[k]] for k in whole], -1, np.array(whole)))
            for key in sorted(set(keys) & set(trees)):
                own = np.array([k for k, x in enumerate(keys) if x == key])
                unit = _unit(_matrix(batch.column(at("vector")).take(pa.array(own))))
                for tree, splits in enumerate(trees[key]):
                    for leaf, rows in parts_of(unit, tree, splits, _margin(key[1], least)):
                        lots.append(([_number(*key, tree, leaf)] * len(rows), tree, own[rows]))
            for places, tree, rows in lots:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(places, pa.int64()),
                        pa.array(np.full(len(rows), tree, np.int32)),
                        *(batch.column(at(c)).take(pa.array(rows)) for c in ("node", "vector")),
                    ],
                    ["place", "tree", "node", "vector"],
                )

    def split(table: pa.Table) -> pa.Table:
        """For each vector the cells (leaves) of this place that hold it. Cells
        of more than BLOCK_ROWS are places of their own."""
        table = table.combine_chunks()
        node = table.column("node").to_numpy()
        order = np.argsort(node)
        node = node[order]
        unit = _unit(_matrix(table.column("vector").combine_chunks()))[order]
        place, tree = table.column("place")[0].as_py(), table.column("tree")[0].as_py()
        held: list[list[int]] = [[] for _ in node]
        out: list[tuple[int, int, list[int], int]] = []
        for t in range(count) if tree < 0 else (tree,):
            for k, rows in enumerate(leaves(unit, t, least, leaf_rows)):
                cell = _number(place, t, k)
                if len(rows) > BLOCK_ROWS:
                    out += [(n, cell, [cell], math.ceil(len(rows) / BLOCK_ROWS)) for n in node[rows].tolist()]
                else:
                    for row in rows.tolist():
                        held[row].append(cell)
        out += [(n, place, cells, 1) for n, cells in zip(node.tolist(), held, strict=True) if cells]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), CELLS.values(), strict=True)], list(CELLS)
        )

    dealt = nodes.select("part", "width", "node", "vector").mapInArrow(
        deal, "place long, tree int, node long, vector array<double>"
    )
    cell_rows = "node long, place long, own array<long>, blocks int"
    if largest <= 2 * PART_ROWS:
        placed = dealt.groupBy("place").applyInArrow(split, cell_rows)
    else:
        over = checkpoint(dealt.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") > 2 * PART_ROWS))
        fitting = dealt.join(over.select("place"), "place", "left_anti")
        whole = dealt.select("node", "place").join(over, "place")  # too large for one task: a cell of its own
        blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")
        placed = fitting.groupBy("place").applyInArrow(split, cell_rows).union(
            whole.select("node", "place", F.array("place").alias("own"), blocks)
        )
    placed = checkpoint(placed)
    cells = placed.groupBy("node").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("cells"))
    entries = placed.join(nodes.select("node", "many", "vector").join(cells, "node"), "node")
    block = F.pmod(F.xxhash64("node", F.lit(2)), "blocks").cast("int")
    entries = entries.select(
        "place", "node", "own", "many", "vector", "cells", block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    entries = entries.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order = np.argsort(table.column("node").to_numpy())
        table = table.take(pa.array(order))
        node, many, block = (table.column(c).to_numpy() for c in ("node", "many", "block"))
        lists = {}
        for c in ("own", "cells"):
            found = table.column(c).combine_chunks()
            flat, sizes = found.flatten().to_numpy(), np.diff(found.offsets.to_numpy())
            lists[c] = np.split(flat, np.cumsum(sizes)[:-1])
        held = _Found(_unit(_matrix(table.column("vector").combine_chunks())), many, lists["cells"], least)
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        flat = np.concatenate(lists["own"])
        owner = np.repeat(np.arange(len(node)), [len(x) for x in lists["own"]])
        by_cell = np.argsort(flat, kind="stable")
        ids, first = np.unique(flat[by_cell], return_index=True)
        for cell, rows in zip(ids.tolist(), np.split(owner[by_cell], first[1:]), strict=True):
            if one == two:
                held.compare(rows, rows, cell)
            else:
                held.compare(rows[block[rows] == one], rows[block[rows] == two], cell)
        linking = np.flatnonzero(held.others)
        links = np.array(held.links, np.int64).reshape(-1, 2)
        none = pa.nulls(len(linking), pa.int64()), pa.nulls(len(links), pa.int64())
        return pa.table(
            {
                "a": pa.concat_arrays([pa.array(node[linking]), pa.array(node[links[:, 0]])]),
                "b": pa.concat_arrays([none[0], pa.array(node[links[:, 1]])]),
                "others": pa.concat_arrays([pa.array(held.others[linking]), none[1]]),
            }
        )

    return entries.groupBy("place", "one", "two").applyInArrow(compare, "a long, b long, others long")
