"""Benchmark decontamination (operator 10): a prefix-filtered set join of
documents with benchmark windows.

A window is ``window`` consecutive words of a benchmark item; an item with
fewer words, but not none, is one window. A window is contained in a document
only if all its shingles are, so one of them, the rarest over all documents,
is a sufficient prefix: documents are joined with the windows on that shingle
alone. A hit must then leave room for the whole window inside the document
(length and position), and all its words are compared.

The benchmark is taken in parts of at most ``part_bytes`` of text. Each part is
indexed, counted, matched and, if there are several, written to the checkpoint
folder before the next one is read, so the driver and the tasks hold one part's
index at a time. Each part costs two passes over the documents, which are never
shuffled.

Null texts have no words; items with a null id or no words match nothing.
Documents sharing an id each give their own row, repeated rows likewise. Of
equally rare shingles the one that comes first in the window is the prefix. An
empty table of documents gives no rows, an empty benchmark no hits; very long
texts are read whole. Other columns are not read; ``uncontaminated`` passes all
of them on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import ALNUM, Block, Words, blocks, checkpoint, column, documents, keyed, map_rows, place, text_array, words

SHINGLE = 3


class Windows:
    """The windows of one part of the benchmark and their shingles."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = [name for name, _ in items]
        texts = pa.array([text for _, text in items], pa.large_string())
        rows: dict[tuple, set[int]] = {}
        for block in blocks(texts):
            found = words(block, ALNUM, lower=True)
            for row in range(block.rows):
                own = found.hash[found.first[row] : found.first[row + 1]]
                for at in range(max(1, len(own) - window + 1) if len(own) else 0):
                    rows.setdefault(tuple(own[at : at + window].tolist()), set()).add(block.first + row)
        self.words = list(rows)
        self.items = [sorted(x) for x in rows.values()]
        self.length = np.array([len(w) for w in self.words], np.int64)

    def shingles(self) -> list[list[tuple[int, int]]]:
        """For each window its shingles as (words in it, hash), by offset."""
        out = []
        for window in self.words:
            n = min(SHINGLE, len(window))
            row = Words(None, None, np.zeros(len(window), np.int64), None, np.array(window, np.uint64))
            hashes, fits = row.grams(n)
            out.append([(n, int(h)) for h in hashes[fits]])
        return out


class Lookup:
    """Finds the given 64-bit values among many: a bitmap first, then a search."""

    def __init__(self, values: list[int]):
        self.values = np.unique(np.array(values, np.uint64))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.values >> np.uint64(48)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that hold a value, and which."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        where = np.searchsorted(self.values, hashes[at])
        where[where == len(self.values)] = 0
        good = self.values[where] == hashes[at] if len(self.values) else np.zeros(len(at), bool)
        return at[good], where[good]


class Index:
    """Windows by their rarest shingle."""

    def __init__(self, windows: Windows, counts: dict[tuple[int, int], int]):
        self.names, self.items = windows.names, windows.items
        self.length = windows.length
        self.words = np.zeros((len(windows.words), int(windows.length.max(initial=0))), np.uint64)
        by_size: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, (own, shingles) in enumerate(zip(windows.words, windows.shingles(), strict=True)):
            self.words[k, : len(own)] = own
            rarest = min(range(len(shingles)), key=lambda j: (counts.get(shingles[j], 0), shingles[j], j))
            size, value = shingles[rarest]
            by_size.setdefault(size, {}).setdefault(value, []).append((k, rarest))
        self.sizes = []
        for size, held in sorted(by_size.items()):
            find = Lookup(list(held))
            lists = [held[int(v)] for v in find.values]
            first = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
            flat = np.array([pair for x in lists for pair in x], np.int64).reshape(-1, 2)
            self.sizes.append((size, find, first, flat))

    def hits(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every occurrence in a block."""
        starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, find, first, flat in self.sizes:
            hashes, fits = found.grams(size)
            at, value = find(hashes)
            at, value = at[fits[at]], value[fits[at]]
            many = first[value + 1] - first[value]
            pick = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[value], many)
            window, offset = flat[pick, 0], flat[pick, 1]
            row, start = np.repeat(found.row[at], many), np.repeat(at, many) - offset
            room = (start >= found.first[row]) & (start + self.length[window] <= found.first[row + 1])
            start, window = start[room], window[room]
            for j in range(self.words.shape[1]):  # all words, one position after the other
                same = self.length[window] <= j
                rest = np.flatnonzero(~same)
                same[rest] = found.hash[start[rest] + j] == self.words[window[rest], j]
                start, window = start[same], window[same]
            starts.append(start)
            which.append(window)
        return np.concatenate(starts), np.concatenate(which)


def _word_blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, Words]]:
    for block in blocks(text_array(batch)):
        yield block, words(block, ALNUM, lower=True)


def _shingle_counts(docs: DataFrame, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """How often each wanted shingle occurs in all documents."""
    by_size = {n: Lookup([h for m, h in wanted if m == n]) for n in {m for m, _ in wanted}}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {n: np.zeros(len(find.values), np.int64) for n, find in by_size.items()}
        for batch in batches:
            for _, found in _word_blocks(batch):
                for n, find in by_size.items():
                    hashes, fits = found.grams(n)
                    at, value = find(hashes)
                    totals[n] += np.bincount(value[fits[at]], minlength=len(find.values))
        for n, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(seen), n, np.int32)),
                    pa.array(by_size[n].values[seen].view(np.int64)),
                    pa.array(total[seen]),
                ],
                ["size", "shingle", "n"],
            )

    counted = docs.select("text").mapInArrow(count, "size int, shingle long, n long")
    rows = counted.groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["shingle"] & ((1 << 64) - 1)): r["n"] for r in rows}


SPANS = "array<struct<start:int,end:int>>"


def _find(docs: DataFrame, index: Index) -> DataFrame:
    """Adds to the documents' keys their word count, hit word runs and items."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, spans, items = [], [], []
            for block, found in _word_blocks(batch):
                starts, windows = index.hits(found)
                cover = np.zeros(len(found.hash) + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + index.length[windows], -1)
                hit = np.cumsum(cover[:-1]) > 0
                rows = found.row[starts]
                touched = set(rows.tolist())
                for row in range(block.rows):
                    first, last = found.first[row], found.first[row + 1]
                    n_words.append(int(last - first))
                    if row not in touched:
                        spans.append([])
                        items.append([])
                        continue
                    edges = np.diff(np.concatenate(([0], hit[first:last].astype(np.int8), [0])))
                    spans.append([
                        {"start": int(s), "end": int(e)}
                        for s, e in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
                    ])
                    own = {i for w in np.unique(windows[rows == row]).tolist() for i in index.items[w]}
                    items.append(sorted({index.names[i] for i in own}))
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            names = ["rid", "rtext", "doc_id"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(items, pa.list_(pa.string()))],
                [*names, "n_words", "spans", "items"],
            )

    schema = f"rid long, rtext long, doc_id long, n_words long, spans {SPANS}, items array<string>"
    return keyed(docs).mapInArrow(find, schema)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Joins the results of several parts of the benchmark, by document."""
    hit = parts[0].where("size(spans) > 0")
    for part in parts[1:]:
        hit = hit.unionByName(part.where("size(spans) > 0"))
    # All words of a document that any part has hit, as the runs they form.
    hit = hit.groupBy("rid", "rtext").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("all_items"),
    )
    runs = F.expr(
        f"""aggregate(raw, cast(array() as {SPANS}), (runs, x) -> if(
              size(runs) = 0 or element_at(runs, -1).end < x.start, concat(runs, array(x)),
              concat(slice(runs, 1, size(runs) - 1), array(named_struct(
                'start', element_at(runs, -1).start, 'end', greatest(element_at(runs, -1).end, x.end))))))"""
    )
    every = parts[0].select("rid", "rtext", "doc_id", "n_words")
    return every.join(hit.select("rid", "rtext", runs.alias("runs"), "all_items"), ["rid", "rtext"], "left").select(
        "rid",
        "rtext",
        "doc_id",
        "n_words",
        F.coalesce("runs", F.expr(f"cast(array() as {SPANS})")).alias("spans"),
        F.coalesce("all_items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def _indexes(
    docs: DataFrame, benchmark: DataFrame, window: int, item_col: str, text_col: str, part_bytes: int
) -> Iterator[tuple[Index, bool]]:
    """The benchmark in parts, each with its windows by rarest shingle, and whether it is the only one."""
    items = benchmark.select(
        column(benchmark, item_col).cast("string").alias("item"),
        column(benchmark, text_col).cast("string").alias("text"),
    ).where("item is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    parts = max(1, -(-2 * size // part_bytes))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()
        windows = Windows([(r["item"], r["text"]) for r in rows], window)
        wanted = sorted({s for own in windows.shingles() for s in own})
        yield Index(windows, _shingle_counts(docs, wanted)), parts == 1


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    part_bytes: int = 8 << 20,
) -> DataFrame:
    """doc_id, n_words, n_hit, spans (runs of hit words, end exclusive), items
    (ids as strings, sorted) and contaminated, for every row of ``df``.

    For each ``part_bytes`` of benchmark text one pass over the documents counts
    the shingles and one finds the hits."""
    docs = documents(df, id_col, text_col)
    found = []
    for index, only in _indexes(docs, benchmark, window, item_col, item_text_col, part_bytes):
        frame = _find(docs, index)
        if found:  # of further parts only documents with hits
            frame = frame.where("size(spans) > 0")
        found.append(frame if only else checkpoint(frame))
    result = found[0] if len(found) == 1 else _merged(found)
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)")
    return result.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items", (F.size("spans") > 0).alias("contaminated")
    )


def uncontaminated(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    part_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows of ``df``, with their own columns, in which no window occurs."""
    docs, text = documents(df, id_col, text_col), df.columns.index(text_col)
    for index, only in _indexes(docs, benchmark, window, item_col, item_text_col, part_bytes):

        def clean(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for block in blocks(text_array(batch, place(text))):
                    found = words(block, ALNUM, lower=True)
                    starts, _ = index.hits(found)
                    good[block.first + found.row[starts]] = False
                yield batch.filter(pa.array(good))

        df = map_rows(df, clean)
        if not only:
            df = checkpoint(df)
    return df
