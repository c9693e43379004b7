"""Near-duplicate documents by min-max hashing (operator 1).

A document is the set of its distinct word shingles, ASCII letters in lower
case. Every permutation gives two signature values, the smallest and the
largest hash, so ``2 * bands`` permutations fill ``bands`` bands of four
values: half the evaluations, and an estimate of lower variance than as many
minima. Documents alike in a band are candidates; links are confirmed on full
sets. With 40 bands of four, a pair at similarity 0.8 is missed with
probability 7e-10.

Documents of equal sets collapse into one class first; ``linking`` compares
classes without expanding buckets into pairs. Its bound here: a class can't
reach the threshold if too few of its shingles occur in another class left.

Null texts and texts without words have empty sets and are linked with
nothing. A null id counts as larger than any other and comes back as null
where nothing smaller is reachable. Rows sharing an id are separate documents;
each row gives a row. Ties for the smallest go to the smaller text hash. An
empty table gives no rows. A very long text is hashed whole, 512 shingles at a
time. Other columns are not read; ``one_of_each`` passes all of them on,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import (
    NO_ID,
    NOT_BLANK,
    Batches,
    blocks,
    checkpoint,
    column,
    counted,
    documents,
    give_back,
    keyed,
    mix,
    text_array,
    unused,
    words,
)
from aerolens.llm.linking import Comparison, linked

BANDS, BAND_VALUES = 40, 4
#: Shingles counted in one place, on average, when classes are thinned out.
PER_PLACE = 250_000
#: Bytes, as counted, up to which a list of wanted documents is broadcast.
BROADCAST_BYTES = 16 << 20

_draw = np.random.default_rng(80)
_FACTORS = _draw.integers(1, 1 << 63, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 63, 2 * BANDS, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for block in blocks(texts):
        found = words(block, NOT_BLANK, lower=True)
        grams, _ = found.grams(size)
        for row in range(block.rows):
            first, last = int(found.first[row]), int(found.first[row + 1])
            if last - first >= size:
                yield np.unique(grams[first : last - size + 1])
            elif last > first:  # the whole sequence is one shingle
                own = found.hash[first:last]
                whole = np.uint64(last - first)
                for value in own:
                    whole = mix(np.array([whole ^ value], np.uint64))[0]
                yield np.array([whole], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Per permutation the smallest and the largest hash."""
    low = np.full(2 * BANDS, ~np.uint64(0))
    high = np.zeros(2 * BANDS, np.uint64)
    for at in range(0, len(shingles), 512):
        hashes = np.multiply.outer(_FACTORS, shingles[at : at + 512])
        hashes += _SHIFTS[:, None]
        np.minimum(low, hashes.min(axis=1), out=low)
        np.maximum(high, hashes.max(axis=1), out=high)
    return np.stack([low, high], axis=1)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band: two permutations' minima and maxima."""
    values = signature(shingles).reshape(BANDS, BAND_VALUES)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_VALUES):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
    return key


def _signed(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cid, bands = [], [], []
            for own in shingle_sets(text_array(batch), size):
                n.append(len(own))
                if len(own):
                    whole = mix(own).sum(dtype=np.uint64) + np.uint64(len(own))
                    cid.append(int(mix(np.array([whole]))[0].view(np.int64)))
                    bands.append(band_keys(own).view(np.int64))
                else:
                    cid.append(None)
                    bands.append(None)
            at = batch.schema.get_field_index
            yield pa.RecordBatch.from_arrays(
                [batch.column(at(c)) for c in ("rid", "rtext", "doc_id")]
                + [pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["rid", "rtext", "doc_id", "n", "cid", "bands"],
            )
        give_back()

    return docs.mapInArrow(run, "rid long, rtext long, doc_id long, n long, cid long, bands array<long>")


class _Sets:
    """Fetches the shingle sets of classes from the documents."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int):
        self.docs, self.classes, self.size = docs, classes, size

    def of(
        self, wanted: DataFrame, keep: list[str], schema: str, then: tuple[Callable[[Batches], Batches], str] | None = None
    ) -> DataFrame:
        """``wanted`` (item and the columns ``keep``, one row a class) with the
        column ``payload``: the packed set. ``then`` is a further step, with its
        schema, for the same worker: two in a row would be two workers a task."""
        size = self.size
        listed = sum((F.size(c) * 48 for c in keep), F.lit(64))  # bytes of a row, rather more than less
        wanted, told = counted(
            wanted.join(self.classes.select(F.col("cid").alias("item"), "rid", "rtext"), "item").select(
                "rid", "rtext", "item", *keep
            ),
            F.sum(listed).alias("bytes"),
        )
        if told["bytes"] <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        # A class stands for rows of one id and text: one of them is enough.
        look = self.docs.select("rid", "rtext", "text").join(wanted, ["rid", "rtext"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index
                for rows in range(0, batch.num_rows, 500):
                    part = batch.slice(rows, 500)
                    packed = [s.tobytes() for s in shingle_sets(text_array(part), size)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(at(c)) for c in ("item", *keep)] + [pa.array(packed, pa.binary())],
                        ["item", *keep, "payload"],
                    )

            give_back()

        if then:
            step, made = then
            return look.mapInArrow(lambda batches: step(run(batches)), made)
        return look.mapInArrow(run, ", ".join(x for x in ("item long", schema, "payload binary") if x))


def _hits(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    where = np.searchsorted(b, a)
    where[where == len(b)] = len(b) - 1
    return int((b[where] == a).sum())


def _comparison(sets: _Sets, low: int, high: int) -> Comparison:
    """Links at a similarity of low / high or more."""

    def alike(a: np.ndarray, b: np.ndarray) -> bool:
        both = _hits(a, b)
        return high * both >= low * (len(a) + len(b) - both)

    def thin_out(left: DataFrame) -> DataFrame:
        items = left.select("item", "size").distinct()
        total = items.agg(F.sum("size")).first()[0] or 0
        shared = _shared(sets, items.select("item"), int(total // PER_PLACE + 1))
        return left.join(shared, "item").where(F.col("shared") * high >= F.col("size") * low)

    return Comparison(
        fetch=sets.of,
        parse=lambda packed: np.frombuffer(packed, np.uint64),
        alike=alike,
        apart=lambda small, large: high * small < low * large,
        apart_column=lambda small, large: small * high < large * low,
        thin_out=thin_out,
    )


def _shared(sets: _Sets, items: DataFrame, partitions: int) -> DataFrame:
    """item and how many of its shingles another of these classes holds too."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = batch.column(batch.schema.get_field_index("item")).to_numpy(zero_copy_only=False)
            lots = [np.frombuffer(s, np.uint64) for s in batch.column(batch.schema.get_field_index("payload")).to_pylist()]
            value = np.concatenate(lots) if lots else np.zeros(0, np.uint64)
            owner = np.repeat(item, [len(x) for x in lots]) if lots else item
            place = (value % np.uint64(partitions)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, value, owner = place[order], value[order], owner[order]
            cut = np.searchsorted(place, np.arange(partitions + 1))
            rows = [k for k in range(partitions) if cut[k] < cut[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int32()),
                    pa.array([value[cut[k] : cut[k + 1]].tobytes() for k in rows], pa.binary()),
                    pa.array([owner[cut[k] : cut[k + 1]].tobytes() for k in rows], pa.binary()),
                ],
                ["place", "value", "owner"],
            )

    def count(table: pa.Table) -> pa.Table:
        value = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("value").to_pylist()])
        owner = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("owner").to_pylist()])
        _, where, n = np.unique(value, return_inverse=True, return_counts=True)
        item, many = np.unique(owner[n[where] > 1], return_counts=True)
        del value, owner, where, n
        give_back()
        return pa.table({"item": pa.array(item), "shared": pa.array(many.astype(np.int64))})

    dealt = sets.of(items, [], "", then=(deal, "place int, value binary, owner binary"))
    return dealt.groupBy("place").applyInArrow(count, "item long, shared long").groupBy("item").agg(F.sum("shared").alias("shared"))


def _grouped(docs: DataFrame, shingle: int, least: Fraction) -> DataFrame:
    """rid, rtext, doc_id and n of all rows, and ``least`` and ``least_text``:
    rid and rtext of the smallest in their component, null for empty sets."""
    signed = checkpoint(_signed(docs, shingle))
    classes = (
        signed.where("n > 0")
        .groupBy("cid")
        .agg(F.min(F.struct("rid", "rtext")).alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("cid", "one.rid", "one.rtext", "n", "bands")
    )
    classes = checkpoint(classes)
    sets = _Sets(docs, classes, shingle)
    entries = classes.select(F.explode("bands").alias("key"), F.col("cid").alias("item"), F.col("n").alias("size"))
    joined = linked(entries, _comparison(sets, least.numerator, least.denominator))

    # The smallest document of each component.
    rep = classes.select("cid", "rid", "rtext").join(joined.select(F.col("id").alias("cid"), "component"), "cid", "left")
    rep = rep.select("cid", "rid", "rtext", F.coalesce("component", "cid").alias("component"))
    smallest = rep.groupBy("component").agg(F.min(F.struct("rid", "rtext")).alias("one"))
    of_class = rep.join(smallest, "component").select(
        "cid", F.col("one.rid").alias("least"), F.col("one.rtext").alias("least_text")
    )
    return signed.select("rid", "rtext", "doc_id", "n", "cid").join(of_class, "cid", "left").drop("cid")


def near_duplicates(
    df: DataFrame, shingle: int = 4, similarity: str = "0.8", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for every row of ``df``."""
    result = _grouped(keyed(documents(df, id_col, text_col)), shingle, Fraction(similarity))
    component = F.coalesce("least", "rid")
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(component != NO_ID, component).alias("component_id"),
        (component == F.col("rid")).alias("kept"),
    )


def one_of_each(
    df: DataFrame, shingle: int = 5, similarity: str = "0.8", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` that stay: one of each group, that of the smallest id
    and then of the smallest text hash. Of rows equal in both, the one that is
    smallest as JSON stays. Rows without words are in no group and all stay."""
    result = _grouped(keyed(documents(df, id_col, text_col)), shingle, Fraction(similarity))
    own, text, row = unused(df, "own_rid", "own_rtext", "own_row")
    marked = (
        result.where("n > 0")
        .groupBy(F.col("rid").alias(own), F.col("rtext").alias(text))
        .agg(F.count("*").alias("many"), F.first("least").alias("least"), F.first("least_text").alias("least_text"))
        .select(own, text, "many", ((F.col(own) == F.col("least")) & (F.col(text) == F.col("least_text"))).alias("stays"))
        .where("not stays or many > 1")
    )
    marked, size = counted(marked, F.sum((F.col("stays")).cast("long")).alias("repeated"))
    rid = F.coalesce(column(df, id_col).cast("long"), F.lit(NO_ID))
    rtext = F.xxhash64(column(df, text_col).cast("string"))

    def same(other: DataFrame) -> Column:
        return (rid == column(other, own)) & (rtext == column(other, text))

    gone = marked.select(own, text)
    single = df.join(gone, same(gone), "left_anti")
    if not size["repeated"]:
        return single
    repeated = marked.where("stays").select(own, text)
    whole = F.struct(*(column(df, c).alias(c) for c in df.columns)).alias(row)
    rows = df.join(repeated, same(repeated)).select(own, text, whole)
    one = rows.groupBy(own, text).agg(F.min_by(row, F.to_json(row)).alias(row))
    fields = [F.col(row).getField(c).alias(c) for c in df.columns]
    return single.union(one.select(*fields))
