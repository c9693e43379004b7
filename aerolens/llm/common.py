"""Helpers shared by the text operators: text blocks as numpy arrays, word and
n-gram hashes, lineage cutting and connected components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that the numpy helpers look at together (one longer text is taken alone).
BLOCK_BYTES = 1 << 17
#: Stands for a null document id where ids are compared: larger than any other.
NO_ID = (1 << 63) - 1


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def counted(df: DataFrame, *sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """``checkpoint(df)`` with its number of rows ``n`` and the named ``sums``, all
    taken while it is written."""
    seen = Observation()
    out = checkpoint(df.observe(seen, F.count(F.lit(1)).alias("n"), *sums))
    found = seen.get
    if "n" not in found:  # the plan was known to be empty before it ran
        found = out.agg(F.count(F.lit(1)).alias("n"), *sums).first().asDict()
    return out, {k: int(v or 0) for k, v in found.items()}


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


Batches = Iterator[pa.RecordBatch]


def map_rows(df: DataFrame, run: Callable[[Batches], Batches], width: int | None = None) -> DataFrame:
    """``df.mapInArrow`` to the first ``width`` of its own columns (all of them by
    default), whatever their names: inside, columns go by ``place``."""
    plain = df.toDF(*(place(k) for k in range(len(df.columns))))
    return plain.mapInArrow(run, StructType(plain.schema.fields[:width])).toDF(*df.columns[:width])


def place(k: int) -> str:
    return f"c{k}"


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` only, whatever else the frame holds."""
    return df.select(
        column(df, id_col).cast("long").alias("doc_id"),
        column(df, text_col).cast("string").alias("text"),
    )


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``rid`` and ``rtext``, which tell rows apart: the id (null: the
    largest long) and a hash of the text, so that rows sharing an id stay apart."""
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("rid"),
        F.xxhash64("text").alias("rtext"),
        "doc_id",
        "text",
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- text blocks


@dataclass
class Block:
    """Some consecutive rows of an Arrow batch: their bytes and row limits."""

    first: int
    data: np.ndarray
    ends: np.ndarray  # len(rows) + 1 positions in data, from 0

    @property
    def rows(self) -> int:
        return len(self.ends) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.ends[row] : self.ends[row + 1]].tobytes()


def one_thread() -> None:
    """Keeps the ``tokenizers`` library to the task's own thread: a task has one
    core, and every further thread holds memory of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """One large object that a worker keeps between tasks of one kind; it goes
    when another one is asked for, or at the end of a task that has no use for it."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def give_back(keep: bool = False) -> None:
    """Returns memory that allocators keep for later to the system, and unless
    ``keep`` the object held: a worker goes on with other tasks, and all workers
    of an executor share its limit."""
    if not keep:
        _held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_array(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with nulls as empty strings."""
    found = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(found, "") if found.null_count else found


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cuts a text array into blocks of about ``limit`` bytes of whole rows."""
    if not len(texts):
        return
    _, where, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(where, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(ends, ends[first] + limit, "right")) - 1, first + 1)
        last = min(last, len(texts))
        yield Block(first, held[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


# -------------------------------------------------------------------- hashing

_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    v = values ^ (values >> np.uint64(30))
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, step in enumerate((_STEP, _STEP_BACK)):
            factors = np.full(size, step, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


class SpanHash:
    """Hashes of arbitrary spans of one sequence of 64-bit values, from prefix
    sums of a polynomial: equal spans hash alike wherever they stand."""

    def __init__(self, values: np.ndarray):
        forth, self.back = _up_to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * forth[: len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


# ---------------------------------------------------------------------- words

#: Byte tables: words are runs of bytes that aren't blank ...
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ... or of ASCII letters and digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a block: byte limits, row, and the first word of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # rows + 1 positions in start
    hash: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they are of one row."""
        size = len(self.hash)
        if size < n:
            return np.zeros(size, np.uint64), np.zeros(size, bool)
        out = np.zeros(size, np.uint64)
        step = np.uint64(1)
        for j in range(n):
            out[: size - n + 1] += self.hash[j : size - n + 1 + j] * step
            with np.errstate(over="ignore"):
                step = step * _STEP
        one_row = np.zeros(size, bool)
        one_row[: size - n + 1] = self.row[: size - n + 1] == self.row[n - 1 :]
        return mix(out), one_row


def words(block: Block, inside: np.ndarray, lower: bool = False) -> Words:
    """Words of a block: maximal runs of bytes that the table ``inside`` holds."""
    data = LOWER[block.data] if lower else block.data
    held = inside[data]
    before = np.zeros(len(held) + 1, bool)
    before[1:] = held
    before[block.ends] = False
    start = np.flatnonzero(held & ~before[:-1])
    after = np.zeros(len(held) + 1, bool)
    after[:-1] = held
    after[block.ends] = False
    end = np.flatnonzero(held & ~after[1:]) + 1
    first = np.searchsorted(start, block.ends)
    row = np.repeat(np.arange(block.rows), np.diff(first))
    return Words(start, end, row, first, SpanHash(byte_values(data))(start, end))


# ----------------------------------------------------------------- components


#: Links whose components one task finds.
TASK_LINKS = 500_000


def _forest(edges: DataFrame, roots: bool) -> DataFrame:
    """For each partition of links the id and the smallest id that its links lead
    to, as (id, root): a star for each component inside the partition. The
    roots themselves are listed if ``roots``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ra, rb = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
        ids = np.fromiter(parent, np.int64, len(parent))
        ends = np.fromiter(map(root, parent), np.int64, len(parent))
        keep = np.ones(len(ids), bool) if roots else ids != ends
        ids, ends = ids[keep], ends[keep]
        for at in range(0, len(ids), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 10_000]), pa.array(ends[at : at + 10_000])], ["id", "root"])

    return edges.select("a", "b").mapInArrow(run, "id long, root long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): (id, component), where the
    component is the smallest id reachable. Ids without an edge are not listed.

    The links are dealt to parts of at most ``TASK_LINKS``, and each part leaves
    a star for each component it knows. With more than one part, every id is then
    sent to the smallest id that any star gives it, and on to that one's own;
    links between what ids were sent to go round again. Ids that are no local
    minimum vanish each time, so a few rounds leave one part, which ends it. Each
    id has at most one link for each part, so no id is hot as a key."""
    live, size = counted(edges.select("a", "b").where("a <> b"))
    sent, ids = [], None
    while True:
        parts = max(1, -(-size["n"] // TASK_LINKS))
        stars = _forest(live.coalesce(parts), roots=parts == 1)
        if parts == 1:
            break
        stars = checkpoint(stars)
        if ids is None:
            ids = stars.select("id").union(stars.select("root")).distinct()
        to = stars.groupBy("id").agg(F.min("root").alias("to"))
        further = to.select(F.col("id").alias("to"), F.col("to").alias("end"))
        to = checkpoint(to.join(further, "to", "left").select("id", F.coalesce("end", "to").alias("to")))
        sent.append(to)
        a = to.select("id", F.col("to").alias("a"))
        b = to.select(F.col("id").alias("root"), F.col("to").alias("b"))
        live, size = counted(
            stars.join(a, "id").join(b, "root", "left").select("a", F.coalesce("b", "root").alias("b")).where("a <> b")
        )
    if ids is None:
        return checkpoint(stars.select("id", F.col("root").alias("component")))
    found = ids.withColumn("component", F.col("id"))
    for to in [*sent, stars.select("id", F.col("root").alias("to"))]:
        step = to.select(F.col("id").alias("component"), "to")
        found = found.join(step, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return checkpoint(found)
