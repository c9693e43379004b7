"""Line dedup by a segment-partition edit join (operator 8).

A line is what stands between line feeds, without blanks at its ends. Lines of
at least ``least_chars`` characters take part. Lines of equal text are one;
different lines are linked if at most ``edits`` insertions, deletions or
replacements of characters lead from one to the other. Of each group of lines
reachable by links the first, by document id and line, stays; all others are
removed from their documents.

Each line is split into ``edits + 1`` segments. Of two lines within ``edits``,
the longer one holds a segment of the shorter one near its place, so lines are
indexed by (length, segment number, segment) and probe the lengths up to
``edits`` below their own with the few substrings that multi-match-aware
selection leaves. What meets in the index is compared by ``linking``, with a
banded bit-parallel edit distance. Index entries and probes travel packed, one
binary row for each task and bucket; equal lines of a task travel once.

Null texts have no lines and stay null. Short lines always stay. Null ids
count as larger than any other. Rows equal in id and text count as one place,
so they keep the same lines. Each row gives a row. Ties for the first place go
to the smaller text hash, then the earlier line. An empty table gives no rows,
a very long text or line is compared whole. Other columns are not read;
``drop_repeated_lines`` passes all of them on, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import (
    NO_ID,
    checkpoint,
    column,
    counted,
    documents,
    give_back,
    keyed,
    map_rows,
    shuffle_partitions,
    text_array,
    unused,
)
from aerolens.llm.linking import Comparison, linked

#: What trimming takes off, beside the line feed between lines.
BLANKS = " \t\r\v\f"
#: Entries a task gathers before it sends them off (21 bytes each).
FLUSH = 400_000
#: Bytes, as counted, up to which a list of wanted lines is broadcast.
BROADCAST_BYTES = 16 << 20


# --------------------------------------------------------------- edit distance


def within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` edits lead from a to b; banded bit-parallel."""
    if abs(len(a) - len(b)) > most:
        return False
    head, tail = _common(a, b), 0
    a, b = a[head:], b[head:]
    tail = _common(a[::-1], b[::-1])
    if tail:
        a, b = a[:-tail], b[:-tail]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) <= most
    if most == 0:
        return False
    return _banded(a, b, most) <= most


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _banded(a: str, b: str, most: int) -> int:
    """Edit distance of a and b (not shorter), or more than ``most``. Only the
    2 * most + 1 diagonals around the main one are kept, as one word of vertical
    differences that moves down a row with each column."""
    width = 2 * most + 1
    full = (1 << width) - 1
    low_end = 1 << (width - 1)
    # Bit k of column j stands for row j - most + k (rows from 0, characters of a).
    plus = full & ~((1 << most) - 1)  # differences +1 below the diagonal's start
    minus = 0
    n, m = len(a), len(b)
    distance = min(n, most)  # of the band's lowest cell, followed down its diagonal
    last = 1 << (min(n, most) - 1 + most)  # the last row, once the band has reached it
    for j in range(m):
        equal = 0
        for k in range(width):
            row = j - most + k
            if 0 <= row < n and a[row] == b[j]:
                equal |= 1 << k
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        up = (minus | ~(diagonal | plus)) & full
        down = diagonal & plus
        if j < n - most:
            distance += not diagonal & low_end
        else:  # the last row stays inside the band: go along it
            distance += bool(up & last) - bool(down & last)
            last >>= 1
        shifted = diagonal >> 1
        plus = (down | ~(shifted | up)) & full
        minus = shifted & up
        if distance - (m - max(j + 1, n - most)) > most:  # each column left saves one at most
            return most + 1
    return distance


# ---------------------------------------------------------- index and probes


@lru_cache(maxsize=512)
def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and size of the parts of a line, the larger ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for k in range(parts):
        own = size + (k >= parts - longer)
        out.append((at, own))
        at += own
    return out


@lru_cache(maxsize=512)
def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(length probed, segment, start, size) of all substrings of a line of
    that length that can be a segment of a line not longer than it."""
    out = []
    for shorter in range(max(0, length - edits), length + 1):
        gap = length - shorter
        for k, (start, size) in enumerate(segments(shorter, edits + 1)):
            low = max(0, start - k, start + gap - (edits - k))
            high = min(length - size, start + k, start + gap + (edits - k))
            out += [(shorter, k, at, size) for at in range(low, high + 1)]
    return out


def line_id(line: str) -> int:
    """What tells lines apart; the same as Spark's xxhash64 of the string."""
    found = xxhash.xxh64_intdigest(line.encode(), 42)
    return found - (1 << 64) if found >> 63 else found


def index_keys(line: str, edits: int) -> tuple[list[int], list[bool]]:
    """Keys of a line's index entries and probes, and which are entries."""
    keys, indexed = [], []
    held = line.encode() if line.isascii() else None
    own = segments(len(line), edits + 1)
    for shorter, k, at, size in probes(len(line), edits):
        part = held[at : at + size] if held is not None else line[at : at + size].encode()
        keys.append(xxhash.xxh64_intdigest(part, shorter * 64 + k))
        indexed.append(shorter == len(line) and at == own[k][0])
    return keys, indexed


#: What travels of a line: a key, the line's id and length, and whether the key is an index entry.
ENTRY = np.dtype([("key", "<u8"), ("item", "<i8"), ("size", "<i4"), ("indexed", "?")])


class Sender:
    """Distinct lines of a task and their index entries and probes."""

    def __init__(self, edits: int, least_chars: int, buckets: int):
        self.edits, self.least, self.buckets = edits, least_chars, buckets
        self.clear()

    def clear(self) -> None:
        self.seen: set[int] = set()
        self.keys, self.indexed = array("Q"), array("B")
        self.items, self.sizes, self.counts = array("q"), array("i"), array("i")

    def add(self, text: str) -> None:
        for line in text.split("\n"):
            line = line.strip(BLANKS)
            if len(line) < self.least:
                continue
            item = line_id(line)
            if item not in self.seen:
                self.seen.add(item)
                keys, indexed = index_keys(line, self.edits)
                self.keys.extend(keys)
                self.indexed.extend(indexed)
                self.items.append(item)
                self.sizes.append(len(line))
                self.counts.append(len(keys))

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """Entries packed by bucket."""
        entries = np.zeros(len(self.keys), ENTRY)
        entries["key"], entries["indexed"] = self.keys, self.indexed
        counts = np.array(self.counts)
        entries["item"], entries["size"] = np.repeat(np.array(self.items), counts), np.repeat(np.array(self.sizes), counts)
        self.clear()
        place = (entries["key"] % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        cut = np.searchsorted(place[order], np.arange(self.buckets + 1))
        for k in range(self.buckets):
            if cut[k] < cut[k + 1]:
                yield k, entries[order[cut[k] : cut[k + 1]]].tobytes()


def _entries(docs: DataFrame, edits: int, least_chars: int, buckets: int) -> DataFrame:
    """(key, item, size) of lines that meet in the index."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(edits, least_chars, buckets)

        def packed() -> Iterator[pa.RecordBatch]:
            rows = list(sender.rows())
            for at in range(0, len(rows), 64):
                place, entries = zip(*rows[at : at + 64], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int32()), pa.array(entries, pa.binary())], ["place", "entries"]
                )

        for batch in batches:
            for text in text_array(batch):
                sender.add(text.as_py())
                if len(sender.keys) >= FLUSH:
                    yield from packed()
        yield from packed()
        give_back()

    def meet(table: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x, ENTRY) for x in table.column("entries").to_pylist()])
        order = np.lexsort((~e["indexed"], e["item"], e["key"]))
        e = e[order]
        first = np.ones(len(e), bool)  # of a key and line; indexed ones come first
        first[1:] = (e["key"][1:] != e["key"][:-1]) | (e["item"][1:] != e["item"][:-1])
        e = e[first]
        cut = np.flatnonzero(np.concatenate(([True], e["key"][1:] != e["key"][:-1])))
        many = np.diff(np.concatenate((cut, [len(e)])))
        e = e[np.repeat((many > 1) & (np.add.reduceat(e["indexed"].astype(np.int64), cut) > 0), many)]
        met = pa.table({
            "key": pa.array(np.ascontiguousarray(e["key"]).view(np.int64)),
            "item": pa.array(np.ascontiguousarray(e["item"])),
            "size": pa.array(e["size"].astype(np.int64)),
        })
        del e, order, first, cut, many
        give_back()
        return met

    sent = docs.select("text").mapInArrow(send, "place int, entries binary")
    return sent.groupBy("place").applyInArrow(meet, "key long, item long, size long")


def _places(docs: DataFrame, least_chars: int) -> DataFrame:
    """Every line that takes part: item, its document and its number there."""
    lines = docs.select("rid", "rtext", F.posexplode(F.split("text", "\n", -1)).alias("line", "written"))
    own = F.trim(F.col("written"), F.lit(BLANKS))
    return lines.where(F.length(own) >= least_chars).select(F.xxhash64(own).alias("item"), "rid", "rtext", "line")


def _comparison(docs: DataFrame, firsts: DataFrame, edits: int) -> Comparison:
    def fetch(wanted: DataFrame, keep: list[str], schema: str) -> DataFrame:
        """The text of lines, from the first document that holds them."""
        wanted = wanted.join(firsts, "item").groupBy("first.rid", "first.rtext").agg(
            F.collect_list(F.struct(F.col("first.line").alias("line"), "item", *keep)).alias("lines")
        )
        def listed(name: str) -> Column:
            return F.aggregate("lines", F.lit(0), lambda n, x: n + F.size(x[name]) * 48)

        lists = sum(map(listed, keep), F.size("lines") * 48 + 64)  # bytes of a row, rather more than less
        wanted, told = counted(wanted, F.sum(lists).alias("bytes"))
        if told["bytes"] <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        look = docs.select("rid", "rtext", "text").join(wanted, ["rid", "rtext"]).select("text", "lines")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lots = batch.column(1)
                told = lots.flatten()
                number = told.field("line").to_pylist()
                payload, at = [], 0
                for text, many in zip(batch.column(0), np.diff(lots.offsets.to_numpy()).tolist(), strict=True):
                    lines = text.as_py().split("\n")
                    payload += [lines[k].strip(BLANKS).encode() for k in number[at : at + many]]
                    at += many
                columns = [told.field(c) for c in ("item", *keep)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(payload, pa.binary())], ["item", *keep, "payload"])

        return look.mapInArrow(cut, f"item long, {schema}, payload binary")

    return Comparison(
        fetch=fetch,
        parse=bytes.decode,
        alike=lambda a, b: within(a, b, edits),
        apart=lambda small, large: large - small > edits,
        apart_column=lambda small, large: large - small > edits,
    )


def repeated_lines(docs: DataFrame, edits: int, least_chars: int) -> DataFrame:
    """(rid, rtext, lines): the numbers of the lines to remove, by document."""
    buckets = 2 * shuffle_partitions(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(buckets, size >> 24))
    places = checkpoint(_places(docs, least_chars))
    firsts = places.groupBy("item").agg(
        F.min(F.struct("rid", "rtext", "line")).alias("first"), F.count("*").alias("many")
    )
    firsts = checkpoint(firsts)
    joined = linked(_entries(docs, edits, least_chars, buckets), _comparison(docs, firsts, edits))
    of_item = firsts.join(joined, firsts["item"] == joined["id"], "left").select(
        "item", "first", "many", F.coalesce("component", "item").alias("component"), F.col("id").isNotNull().alias("linked")
    )
    of_item = of_item.where("many > 1 or linked")
    kept = of_item.groupBy("component").agg(F.min("first").alias("kept"))
    gone = places.join(of_item.join(kept, "component").select("item", "kept"), "item").where(
        "struct(rid, rtext, line) <> kept"
    )
    return gone.groupBy("rid", "rtext").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def _without(text: str | None, gone: list[int] | None) -> str | None:
    if text is None or not gone:
        return text
    out = set(gone)
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in out)


def line_dedup(
    df: DataFrame, edits: int = 2, least_chars: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, removed (numbers of the removed lines) and kept (the text
    without them), for every row of ``df``."""
    docs = keyed(documents(df, id_col, text_col))
    found = repeated_lines(docs, edits, least_chars)
    whole = docs.join(found, ["rid", "rtext"], "left").select(
        "doc_id", "text", F.coalesce("lines", F.expr("cast(array() as array<int>)")).alias("removed")
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            kept = pa.array(list(map(_without, texts, gone)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, kept], ["doc_id", "text", "removed", "kept"])

    return whole.mapInArrow(keep, "doc_id long, text string, removed array<int>, kept string")


def drop_repeated_lines(
    df: DataFrame, edits: int = 2, least_chars: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``df`` with repeated lines taken out of its text. Documents of which
    nothing but blanks is left, as all their lines stand elsewhere, go."""
    found = repeated_lines(keyed(documents(df, id_col, text_col)), edits, least_chars)
    names = unused(df, "own_rid", "own_rtext", "own_lines")
    found = found.toDF(*names)
    rid = F.coalesce(column(df, id_col).cast("long"), F.lit(NO_ID))
    rtext = F.xxhash64(column(df, text_col).cast("string"))
    own = df.columns.index(text_col)
    same = (rid == found[names[0]]) & (rtext == found[names[1]])
    whole = df.join(found, same, "left").select(*(column(df, c) for c in df.columns), found[names[2]])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column(batch.num_columns - 1).to_pylist()
            texts = list(map(_without, batch.column(own).to_pylist(), gone))
            columns = batch.columns[:-1]
            columns[own] = pa.array(texts, columns[own].type)
            there = [not g or bool(t.strip(BLANKS + "\n")) for t, g in zip(texts, gone, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array(there, pa.bool_()))

    return map_rows(whole, keep, len(df.columns))
