"""Finding repeated passages of a fixed length across all documents.

Both passage operators (by words, by bytes) share these steps; they differ in
how the remaining passages are compared.

1. *Anchors.* Every window of ``length`` units holds a smallest k-gram by hash;
   equal windows have it at the same place. Windows of a document that share
   one are a *block*, about ``2 / (length - k + 2)`` of them a unit.
2. *Exchange.* Blocks travel as (anchor, content hash, place), packed into one
   binary row for each task and bucket of anchors; the number of buckets
   follows the size of the text. Copies met inside a task are settled there
   and go on as one entry, so a passage held by a third of all documents
   arrives as a few entries from each task.
3. *Classes.* Blocks of one anchor and one content hold the same windows and
   are settled as a class. Only an anchor with several contents needs a closer
   look; for each content one block's text is fetched from its document.
4. *Comparison.* The operator compares those blocks, bucket by bucket. Anchors
   with more than ``HOT_CLASSES`` contents are dealt out by the windows'
   128-bit fingerprints instead, so no bucket holds all of a hot anchor.

Documents are dealt out once, into parts of about ``PART_BYTES``, and meet what
is found about them part by part. They are told apart by id and text hash, see
``common.keyed``; rows equal in both are compared as separate documents and get
the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import NO_ID, Block, SpanHash, blocks, give_back, keyed, shuffle_partitions, text_array

#: Blocks that a task gathers before it sends them off.
FLUSH = 1_000_000
#: Blocks meant for one bucket, and text meant for one part of the documents,
#: on average: at most, and at least where there are more partitions than that
#: takes. Buckets and parts tell each other something, so both stay few.
PER_BUCKET, LEAST_PER_BUCKET = 1_000_000, 100_000
PART_BYTES, LEAST_PART_BYTES = 8 << 20, 1 << 20
#: Contents of one anchor beyond which windows travel by fingerprint.
HOT_CLASSES = 4000

SETTLED, COMPARE, REFERENCE, HOT, HOT_REFERENCE = 1, 2, 3, 4, 5

ENTRY = np.dtype([("anchor", "<u4"), ("content", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("size", "u1"), ("many", "u1")])
FOUND = np.dtype([("place", "<u4"), ("doc", "<u4"), ("start", "<u4"), ("size", "u1"), ("status", "u1")])
PLACE = np.dtype([("doc", "<u4"), ("start", "<u4"), ("size", "<u4"), ("status", "u1")])
PRINT = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("many", "u1")])
RUN = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])
DOC = np.dtype([("rid", "<i8"), ("rtext", "<i8")])


@dataclass(frozen=True)
class Passages:
    """What the two operators differ in."""

    length: int  # units in a window, at most 100
    gram: int  # units in an anchor
    #: of a text block: a hash for each unit, and the first unit of each row
    units: Callable[[Block], tuple[np.ndarray, np.ndarray]]
    #: of a text: a function from (first unit, end unit) to the bytes of that passage
    cutter: Callable[[bytes], Callable[[int, int], bytes]]
    #: whether only windows that a smaller id holds count (else: any other place)
    by_order: bool
    #: (passages, document ids, REFERENCE or COMPARE) to the hits: passage and window start
    compare: Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


# --------------------------------------------------------------------- anchors


def anchored(values: np.ndarray, first: np.ndarray, length: int, gram: int):
    """Blocks of a text block: row, first unit (in the row), units, anchor hash, content hash."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(values) < length:
        return none
    span = SpanHash(values)
    n_grams = len(values) - gram + 1
    at = np.arange(n_grams)
    grams = span(at, at + gram)
    width = length - gram + 1
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    step, reach = low, 1
    while reach * 2 <= width:
        step = np.minimum(step[:-reach], step[reach:])
        reach *= 2
    if reach < width:
        step = np.minimum(step[: len(low) - width + 1], step[width - reach :])
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(step)]
    start = np.flatnonzero(np.arange(len(step)) + length <= first[row + 1])
    if not len(start):
        return none
    least = step[start]
    cut = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    begin = start[cut]
    last = start[np.concatenate((cut[1:], [len(start)])) - 1]
    anchor = grams[(least[cut] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    row = row[begin]
    return row, begin - first[row], last + length - begin, anchor, span(begin, last + length)


# ---------------------------------------------------------------- first stage


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and where each group starts in it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        held = key[order]
        new[1:] |= held[1:] != held[:-1]
    return order, np.flatnonzero(new)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Limits of the runs of equal values."""
    if len(values):
        cut = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist()
        yield from zip(cut, [*cut[1:], len(values)], strict=True)


def merged(runs: np.ndarray) -> np.ndarray:
    """Runs of documents put together where they touch, by document and start."""
    if not len(runs):
        return runs
    order = np.lexsort((runs["start"], runs["doc"]))
    doc, start, end = (runs[c][order].astype(np.int64) for c in ("doc", "start", "end"))
    wide = int(end.max()) + 1  # one document after the other on one line
    start, reach = doc * wide + start, np.maximum.accumulate(doc * wide + end)
    cut = np.flatnonzero(np.concatenate(([True], (start[1:] > reach[:-1]) | (doc[1:] != doc[:-1]))))
    out = np.zeros(len(cut), RUN)
    out["doc"] = doc[cut]
    out["start"] = start[cut] - doc[cut] * wide
    out["end"] = reach[np.concatenate((cut[1:], [len(doc)])) - 1] - doc[cut] * wide
    return out


def runs_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    runs = np.zeros(len(doc), RUN)
    runs["doc"], runs["start"], runs["end"] = doc, start, end
    return merged(runs)


#: Bytes of a value that travel, where not all do: with the anchor's 32 bits and
#: its bucket's, 40 bits of the content leave chance matches out of reach.
CARRIED = {"content": 5}


def _with_docs(docs: np.ndarray, entries: np.ndarray) -> bytes:
    """Entries behind the documents they name, numbered anew. Values travel
    byte by byte (all first bytes, all second bytes ...), as that compresses."""
    used, renamed = np.unique(entries["doc"], return_inverse=True)
    parts = [np.int64([len(used), len(entries)]).tobytes(), docs[used].tobytes()]
    for name in entries.dtype.names:
        values = renamed.astype(entries.dtype[name]) if name == "doc" else np.ascontiguousarray(entries[name])
        planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
        parts.append(planes[: CARRIED.get(name, values.itemsize)].tobytes())
    return b"".join(parts)


def _read(payloads: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Documents and entries of several packed rows, as one table each."""
    docs, entries, base = [], [], 0
    for payload in payloads:
        n, many = np.frombuffer(payload, np.int64, 2).tolist()
        docs.append(np.frombuffer(payload, DOC, n, 16))
        at = 16 + n * DOC.itemsize
        own = np.zeros(many, kind)
        for name in kind.names:
            size = kind[name].itemsize
            carried = CARRIED.get(name, size)
            planes = np.zeros((size, many), np.uint8)
            planes[:carried] = np.frombuffer(payload, np.uint8, carried * many, at).reshape(carried, many)
            own[name] = np.ascontiguousarray(planes.T).view(kind[name]).reshape(many)
            at += carried * many
        own["doc"] += base
        base += n
        entries.append(own)
    return np.concatenate(docs), np.concatenate(entries)


class Sender:
    """Gathers the blocks of a task, settles copies met there, and packs the rest."""

    def __init__(self, passages: Passages, buckets: int, parts: int):
        self.passages, self.buckets, self.parts_n = passages, buckets, parts
        self.clear()

    def clear(self) -> None:
        self.docs: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.n_docs = self.size = 0

    def add(self, block: Block, keys: np.ndarray) -> None:
        values, first = self.passages.units(block)
        row, start, size, anchor, content = anchored(values, first, self.passages.length, self.passages.gram)
        if len(row):
            self.docs.append(keys)
            self.parts.append((row + self.n_docs, start, size, anchor, content))
            self.n_docs += block.rows
            self.size += len(row)

    def rows(self) -> Iterator[tuple]:
        """(place, part, payload): blocks packed by bucket, settled runs by part."""
        if not self.size:
            return
        docs = np.concatenate(self.docs)
        doc, start, size, anchor, content = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.clear()
        order = np.argsort(content)  # equal contents have equal anchors
        held = content[order]
        cut = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
        n = np.diff(np.concatenate((cut, [len(doc)])))
        send = np.zeros(len(doc), bool)
        many = np.empty(len(doc), np.uint8)
        many[order] = np.repeat(np.minimum(n, 2), n)
        if self.passages.by_order:
            rid = docs["rid"][doc[order]]
            send[order] = rid == np.repeat(np.minimum.reduceat(rid, cut), n)
            known = ~send
        else:
            send[order[cut]] = True
            known = many > 1
        yield from _to_parts(docs, runs_of(doc[known], start[known], (start + size)[known]), self.parts_n, self.buckets)
        bucket = ((anchor >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)[send]
        order = np.argsort(bucket.astype(np.uint16) if self.buckets < 1 << 16 else bucket, kind="stable")
        entries = np.zeros(len(order), ENTRY)
        for name, values in (("anchor", anchor), ("content", content), ("doc", doc), ("start", start), ("size", size), ("many", many)):
            entries[name] = values[send][order]  # of the anchor the low half
        for a, b in _runs(bucket[order]):
            yield int(bucket[order[a]]), None, _with_docs(docs, entries[a:b])


def _to_parts(docs: np.ndarray, entries: np.ndarray, parts: int, places: int, mark: bytes = b"") -> Iterator[tuple]:
    """Entries about documents, packed by the part that holds these."""
    if len(entries):
        part = ((docs["rid"] ^ docs["rtext"]) % parts)[entries["doc"]]
        order = np.argsort(part, kind="stable")
        for a, b in _runs(part[order]):
            own = int(part[order[a]])
            yield own % places, own, mark + _with_docs(docs, entries[order[a:b]])


ROW = "place int, part int, payload binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "part", "payload"]
    )


def _batches(rows: Iterator[tuple], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 32
        if size > limit:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _table(rows: Iterator[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(list(rows))])


def _keys(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    docs = np.zeros(batch.num_rows, DOC)
    for c in ("rid", "rtext"):
        docs[c] = batch.column(c).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(c).to_numpy()
    return docs


def _send(docs: DataFrame, passages: Passages, buckets: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(passages, buckets, parts)
        for batch in batches:
            keys = _keys(batch)
            for block in blocks(text_array(batch)):
                sender.add(block, keys[block.first : block.first + block.rows])
                if sender.size >= FLUSH:
                    yield from _batches(sender.rows())
        yield from _batches(sender.rows())
        give_back()

    return docs.select("rid", "rtext", "text").mapInArrow(run, ROW)


# --------------------------------------------------------------- second stage

#: Sub-buckets of each bucket, by further bits of the anchor, for comparing text.
FINER = 16


def _classes(passages: Passages, parts: int):
    """Settles blocks by class; what needs a closer look is told to its document."""

    def settle(bucket: int, packed: list[bytes]) -> Iterator[tuple]:
        docs, e = _read(packed, ENTRY)
        order, cut = _groups(e["anchor"], e["content"])
        e = e[order]
        n = np.diff(np.concatenate((cut, [len(e)])))
        new_anchor = np.concatenate(([True], e["anchor"][cut][1:] != e["anchor"][cut][:-1]))
        classes = np.diff(np.concatenate((np.flatnonzero(new_anchor), [len(cut)])))
        classes = np.repeat(np.repeat(classes, classes), n)  # contents of each entry's anchor
        status = np.zeros(len(e), np.uint8)
        if passages.by_order:
            rid = docs["rid"][e["doc"]]
            status[rid > np.repeat(np.minimum.reduceat(rid, cut), n)] = SETTLED
            status[(status == 0) & (classes > 1)] = COMPARE
        else:
            many = np.repeat(np.add.reduceat(e["many"].astype(np.int64), cut), n) > 1
            head = np.zeros(len(e), bool)
            head[cut] = True
            status[many] = SETTLED
            status[~many & (classes > 1)] = COMPARE
            status[many & head & (classes > 1)] = REFERENCE
        hot = classes > HOT_CLASSES
        status[hot & (status == COMPARE)] = HOT
        status[hot & (status == REFERENCE)] = HOT_REFERENCE
        sure = np.isin(status, (SETTLED, REFERENCE, HOT_REFERENCE))
        start, size = e["start"][sure].astype(np.int64), e["size"][sure]
        yield from _to_parts(docs, runs_of(e["doc"][sure], start, start + size), parts, parts, b"S")
        look = status > SETTLED
        found = np.zeros(int(look.sum()), FOUND)
        found["place"] = bucket * FINER + e["anchor"][look] % FINER
        for name in ("doc", "start", "size"):
            found[name] = e[name][look]
        found["status"] = status[look]
        yield from _to_parts(docs, found, parts, parts, b"F")

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("place", "part", "payload")), strict=True))
        out = [(part, part, b"S" + payload) for _, part, payload in rows if part is not None]
        packed = [payload for _, part, payload in rows if part is None]
        if packed:
            out += settle(rows[0][0], packed)
        return _table(out)

    return run


def _marked(table: pa.Table, mark: bytes) -> list[bytes]:
    return [x[1:] for x in table.column("payload").to_pylist() if x[:1] == mark]


def _cut(passages: Passages, places: int):
    """Fetches the text of blocks to compare, for a part of the documents;
    settled runs go on."""

    def rows(docs: pa.Table, told: pa.Table) -> Iterator[tuple]:
        part = told.column("part")[0].as_py() if told.num_rows else 0
        for payload in _marked(told, b"S"):
            yield part % places, part, b"S" + payload
        packed = _marked(told, b"F")
        if not packed:
            return
        keys, found = _read(packed, FOUND)
        at = {}
        for i, key in enumerate(_keys(docs).tolist()):
            at.setdefault(key, []).append(i)
        found = found[np.lexsort((found["start"], found["doc"]))]
        texts: list[bytes] = []
        prints: list[tuple] = []
        column = docs.column("text")
        keep = np.zeros(len(found), bool)
        key_of = keys.tolist()
        last, cut = None, None
        for k, (place, doc, start, size, status) in enumerate(found.tolist()):
            key = key_of[doc]
            if key != last:
                cut = passages.cutter((column[at[key][0]].as_py() or "").encode())
                last = key
            if status <= REFERENCE:
                keep[k] = True
                texts.append(cut(start, start + size))
            else:
                for s in range(start, start + size - passages.length + 1):
                    digest = hashlib.blake2b(cut(s, s + passages.length), digest_size=16).digest()
                    prints.append((*np.frombuffer(digest, "<u8").tolist(), doc, s, 1 + (status == HOT_REFERENCE)))
        found = found[keep]
        order = np.argsort(found["place"], kind="stable")
        for a, b in _runs(found["place"][order]):
            own = order[a:b]
            lot = [texts[k] for k in own.tolist()]
            entries = np.zeros(len(own), PLACE)
            for name in ("doc", "start", "status"):
                entries[name] = found[name][own]
            entries["size"] = [len(t) for t in lot]
            head = _with_docs(keys, entries)
            yield int(found["place"][own[0]]), None, b"T" + np.int64(len(head)).tobytes() + head + b"".join(lot)
        if prints:
            entries = np.array(prints, PRINT)
            place = (entries["high"] % np.uint64(places)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            for a, b in _runs(place[order]):
                yield int(place[order[a]]), None, b"P" + _with_docs(keys, entries[order[a:b]])

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        return _table(rows(docs, told))

    return run


# ---------------------------------------------------------------- third stage


def _compare(passages: Passages, parts: int):
    def rows(table: pa.Table) -> Iterator[tuple]:
        for part, payload in zip(table.column("part").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if payload[:1] == b"S":
                yield part, part, payload[1:]
        texts, heads = [], []
        for payload in _marked(table, b"T"):
            size = int(np.frombuffer(payload, np.int64, 1)[0])
            heads.append(payload[8 : 8 + size])
            at = 8 + size
            for n in _read(heads[-1:], PLACE)[1]["size"].tolist():
                texts.append(payload[at : at + n])
                at += n
        if texts:
            docs, e = _read(heads, PLACE)
            passage, window = passages.compare(texts, docs["rid"][e["doc"]], e["status"])
            start = e["start"][passage].astype(np.int64) + window
            yield from _to_parts(docs, runs_of(e["doc"][passage], start, start + passages.length), parts, parts)
        prints = _marked(table, b"P")
        if prints:
            docs, e = _read(prints, PRINT)
            order, cut = _groups(e["high"], e["low"])
            e = e[order]
            n = np.diff(np.concatenate((cut, [len(e)])))
            if passages.by_order:
                rid = docs["rid"][e["doc"]]
                hit = rid > np.repeat(np.minimum.reduceat(rid, cut), n)
            else:
                hit = np.repeat(np.add.reduceat(e["many"].astype(np.int64), cut), n) > 1
            e = e[hit]
            start = e["start"].astype(np.int64)
            yield from _to_parts(docs, runs_of(e["doc"], start, start + passages.length), parts, parts)

    def run(table: pa.Table) -> pa.Table:
        return _table(rows(table))

    return run


# ----------------------------------------------------------------- all stages


def _finished(finish: Callable[[list[str], list[np.ndarray]], dict[str, pa.Array]], names: list[str]):
    """Hands each document of a part, with its runs, to the operator."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        runs: dict[tuple, np.ndarray] = {}
        payloads = told.column("payload").to_pylist()
        if payloads:
            keys, e = _read(payloads, RUN)
            # The same document may be told about by several rows.
            unique, which = np.unique(keys, return_inverse=True)
            e["doc"] = which[e["doc"]]
            e = merged(e)
            for a, b in _runs(e["doc"]):
                runs[tuple(unique[e["doc"][a]].tolist())] = e[a:b]
        none = np.zeros(0, RUN)
        keys = _keys(docs)
        own = [runs.get(key, none) for key in keys.tolist()]
        texts = docs.column("text").to_pylist()
        columns = finish([t or "" for t in texts], own)
        ids = pa.array([None if r == NO_ID else r for r in keys["rid"].tolist()], pa.int64())
        return pa.table({"doc_id": ids, **columns}).select(names)

    return run


def without_repeats(docs: DataFrame, passages: Passages, finish, schema: str) -> DataFrame:
    """``finish`` (texts and their repeated runs, in units, to columns) over all
    rows of ``docs`` (doc_id, text); ``schema`` begins with ``doc_id long``.

    One small job sums the text lengths while the plan is built; everything
    else is one plan, in which the documents are dealt out by part once."""
    docs = keyed(docs)
    partitions = shuffle_partitions(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    per_unit = 1 if passages.by_order else 6
    expected = size / per_unit * 2 / (passages.length - passages.gram + 2)
    buckets = int(max(1, expected / PER_BUCKET, min(partitions, expected / LEAST_PER_BUCKET)))
    parts = int(max(1, size / PART_BYTES, min(2 * partitions, size / LEAST_PART_BYTES)))

    part = F.pmod(F.col("rid").bitwiseXOR(F.col("rtext")), F.lit(parts)).cast("int").alias("part")
    by_part = docs.select(part, "rid", "rtext", "text").groupBy("part")
    told = _send(docs, passages, buckets, parts).groupBy("place").applyInArrow(_classes(passages, parts), ROW)
    cut = by_part.cogroup(told.groupBy("part")).applyInArrow(_cut(passages, buckets * FINER), ROW)
    runs = cut.groupBy("place").applyInArrow(_compare(passages, parts), ROW)
    names = [c.split()[0] for c in schema.split(", ")]
    return by_part.cogroup(runs.groupBy("part")).applyInArrow(_finished(finish, names), schema)
