"""Cross-tokenizer alignment with corpus-wide pair counts (operator 11).

Each text is encoded by a byte-level BPE (side A, a ``tokenizers`` file) and by
a piece model (side B, a ``sentencepiece`` file). Byte offsets at which a token
of A and one of B both end cut the tokens into groups; the two tokens that end
there are a link. Every link's id pair is counted over the whole corpus.

Counting is external. A task takes its documents in blocks of some megabytes
and radix-partitions a block's pair-document records by the low digits of the B
id; each part is a run, sorted by B id, A id and document and compressed by
zstd. Runs carry their pairs' numbers in front, so a pair that stands in every
document travels once for each block. The runs of a radix are merged k at a
time by a heap over their heads until one is left. The order has side B first,
so all pairs of a B id leave the last merge together, with their maximum.
Counts and maxima then stream back, run by run, to the pair-document records of
their block, which add them up for each document.

White space cuts a text into units that both sides encode on their own (checked
against B's vocabulary), so a unit met before is looked up. A text of which a
unit comes back changed is encoded whole.

Null and empty texts, and texts whose joined tokens differ in their bytes from
a space and the text on either side, have no tokens: zeros, and '' for the
groups. Ties for a B id's highest count are all the highest. Rows are separate
whatever their id: repeated rows each give a row (and count each), a null id
stays null. An empty table gives no rows. A very long text is a block of its
own. Other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolens.llm.byte_bpe import SPACE, byte_alphabet
from aerolens.llm.common import checkpoint, documents, give_back, held, one_thread, text_array

#: Bytes of text whose pair-document records make up a block's runs.
BLOCK_TEXT = 4 << 20
#: Parts of a block by the low digits of the B id.
RADIX = 16
#: Runs merged at a time.
FAN = 64
#: Units a worker remembers in each of two generations, and the longest that it does.
KEPT_UNITS, KEPT_CHARS = 160_000, 40
#: Characters of new units that are encoded together, and of texts looked at together.
LOT_CHARS, CHUNK_CHARS = 40_000, 500_000


class Unit:
    """Tokens of a stretch of text that both sides encode on its own."""

    __slots__ = ("n_a", "n_b", "n_groups", "groups", "codes", "whole")

    def __init__(self, n_a: int, n_b: int, n_groups: int, groups: str, codes: bytes, whole: bool):
        self.n_a, self.n_b, self.n_groups = n_a, n_b, n_groups
        self.groups, self.codes, self.whole = groups, codes, whole


#: A text whose tokens don't give back its bytes.
NOTHING = Unit(0, 0, 0, "", b"", False)


class Aligner:
    """Both encoders, the bytes of their tokens, and the units met so far."""

    def __init__(self, a_file: str, b_file: str):
        one_thread()
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ids = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(ids.values()) + 1)
        for entry, k in ids.items():
            self.a_bytes[k] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([str(k) for k in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        # White space that a piece holds after something else doesn't part units.
        inside = re.compile(f"(?<=[^{SPACE}▁])[{SPACE}▁]")
        crossing = {c for p in pieces for c in inside.findall(p)}
        self.parted = " " not in crossing and "▁" not in crossing
        more = "".join(f"\\u{ord(c):04x}" for c in sorted(crossing))
        tail = f"(?:[{more}][{SPACE}]*[^{SPACE}]*)*" if more else ""
        self.cut = re.compile(f"[{SPACE}]*[^{SPACE}]+{tail}|[{SPACE}]+").findall
        self.known: dict[str, Unit] = {}
        self.older: dict[str, Unit] = {}
        self.broken: set[str] = set()

    def together(self, units: list[str]) -> list[Unit] | None:
        """Units, the first with a space in front, encoded one after another as
        one text; None if their bytes don't come back or a token spans two."""
        text = "".join(units)
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:], num_threads=1), np.int64)
        raw, a_list, b_list = text.encode(), a.tolist(), b.tolist()
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        if b"".join([a_bytes[k] for k in a_list]) != raw or b"".join([b_bytes[k] for k in b_list]) != raw:
            return None
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        where = np.searchsorted(b_end, a_end)
        at_a = np.flatnonzero(b_end[where] == a_end)  # tokens of A that end a group
        at_b = where[at_a]
        end = np.cumsum([len(u) for u in units] if text.isascii() else [len(u.encode()) for u in units])
        last = np.searchsorted(a_end[at_a], end)
        if (last == len(at_a)).any() or (a_end[at_a[last]] != end).any():
            return None
        a_text, b_text = self.a_text, self.b_text
        said, i, j = [], 0, 0
        for k, m in zip(at_a.tolist(), at_b.tolist(), strict=True):
            if k == i and m == j:
                said.append(f"{a_text[a_list[k]]}|{b_text[b_list[m]]}")
            else:
                left, right = a_list[i : k + 1], b_list[j : m + 1]
                said.append(",".join([a_text[x] for x in left]) + "|" + ",".join([b_text[x] for x in right]))
            i, j = k + 1, m + 1
        codes = ((b[at_b] << 32) | a[at_a]).astype(np.uint64).tobytes()
        n_a, n_b = (np.diff(x[last] + 1, prepend=0).tolist() for x in (at_a, at_b))
        out, first = [], 0
        for k, until in enumerate((last + 1).tolist()):
            out.append(Unit(n_a[k], n_b[k], until - first, ";".join(said[first:until]), codes[8 * first : 8 * until], True))
            first = until
        return out

    def alone(self, unit: str) -> Unit:
        """One unit or text; what has no space in front gets one, taken off again."""
        if unit[0] == " ":
            found = self.together([unit])
            return found[0] if found else NOTHING
        found = self.together([" ", unit])
        return found[1] if found else NOTHING

    def learn(self, wanted: list[str]) -> None:
        """Looks up or encodes all of ``wanted``."""
        new = []
        for unit in wanted:
            if unit in self.known:
                continue
            found = self.older.get(unit)
            if found is None:
                new.append(unit)
            else:
                self.known[unit] = found
        # Blank units and those that hold B's sign for a space stand alone; what
        # is encoded together begins with a space.
        plain = [u for u in new if not u.isspace() and "▁" not in u]
        plain.sort(key=lambda u: u[0] != " ")
        alone = set(new) - set(plain)
        at = 0
        while at < len(plain):
            lot, size = [], 0
            while at < len(plain) and (not lot or size < LOT_CHARS):
                lot.append(plain[at])
                size += len(plain[at])
                at += 1
            found = self.together(lot) if lot[0][0] == " " else None
            if found:
                self.known.update(zip(lot, found, strict=True))
            else:
                alone.update(lot)
        for unit in alone:
            found = self.known[unit] = self.alone(unit)
            if not found.whole:
                self.broken.add(unit)

    def forget(self) -> None:
        """Keeps two generations of units, none of them long."""
        if len(self.known) > KEPT_UNITS:
            self.older = {u: x for u, x in self.known.items() if len(u) <= KEPT_CHARS and x.whole}
            self.known = {}
            self.broken.clear()

    def parts(self, texts: list[str], number: dict[str, int], units: list[Unit]) -> list[list[str]]:
        """For each text its units (the text as one unit if it can't be parted,
        none if its bytes don't come back). All of them are numbered: ``number``
        and ``units`` hold those met before and take in the new ones."""
        cuts = [(self.cut(" " + t) if self.parted else [" " + t]) if t else [] for t in texts]
        new = [u for u in set().union(*cuts) if u not in number]
        self.learn(new)
        if self.broken:
            for k, text in enumerate(texts):
                if not self.broken.isdisjoint(cuts[k]):
                    whole = self.alone(" " + text)
                    self.known[" " + text] = whole
                    cuts[k] = [" " + text] if whole.whole else []
                    new += cuts[k]
        for unit in new:
            if unit not in number and self.known[unit].whole:  # others are looked at each time
                number[unit] = len(units)
                units.append(self.known[unit])
        return cuts


def aligner(a_file: str, b_file: str) -> Aligner:
    return held(("aligner", a_file, b_file), lambda: Aligner(a_file, b_file))


# ------------------------------------------------------------------------ runs


def packed(*columns: np.ndarray) -> bytes:
    """Equally long columns of whole numbers, as differences, compressed."""
    deltas = [np.diff(c.astype(np.int64), prepend=0).astype("<i8") for c in columns]
    wide = np.stack(deltas).view(np.uint8).reshape(len(columns), -1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide.transpose(0, 2, 1)).tobytes())


def unpacked(run: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), np.uint8)
    wide = np.ascontiguousarray(raw.reshape(columns, 8, -1).transpose(0, 2, 1)).view("<i8").reshape(columns, -1)
    return list(np.cumsum(wide, axis=1))


def starts(values: np.ndarray) -> np.ndarray:
    """Positions at which a sorted array changes its value, the first included."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


class BlockRuns:
    """Pair-document records of a block of documents."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.units: list[Unit] = []
        self.seen: list[np.ndarray] = []
        self.text = 0

    def add(self, cut: list[str], size: int) -> None:
        self.seen.append(np.fromiter(map(self.number.__getitem__, cut), np.int32, len(cut)))
        self.text += size

    def lines(self, groups: bool) -> dict[str, list]:
        """What documents' units add up to by themselves."""
        texts = [u.groups for u in self.units]
        out = {c: [] for c in ("n_a", "n_b", "n_groups", "groups_sha256", "groups")}
        for column in ("n_a", "n_b", "n_groups"):
            each = np.array([getattr(u, column) for u in self.units], np.int64)
            out[column] = [int(each[own].sum()) for own in self.seen]
        for own in self.seen:
            said = ";".join([texts[n] for n in own.tolist()])
            out["groups_sha256"].append(hashlib.sha256(said.encode()).hexdigest() if len(own) else "")
            out["groups"].append(said if groups else None)
        return out

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(radix, pairs with their numbers, records of pair, document and number)."""
        n_units = max(len(self.units), 1)
        row = np.repeat(np.arange(len(self.seen)), [len(x) for x in self.seen])
        unit = np.concatenate(self.seen).astype(np.int64) if self.seen else row
        key, times = np.unique(row * n_units + unit, return_counts=True)
        row, unit = key // n_units, key % n_units
        many = np.array([len(u.codes) // 8 for u in self.units], np.int64)
        codes = np.frombuffer(b"".join(u.codes for u in self.units), np.uint64)
        code, place = np.unique(codes, return_inverse=True)
        first, own = np.cumsum(many) - many, many[unit]
        at = np.repeat(first[unit] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        row, times, pair = np.repeat(row, own), np.repeat(times, own), place[at]
        rows = max(len(self.seen), 1)
        key = pair * rows + row
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        cut = starts(key)
        key, times = key[cut], np.add.reduceat(times, cut) if len(cut) else times
        pair, row = key // rows, key % rows
        total = np.zeros(len(code), np.int64)
        np.add.at(total, pair, times)
        radix = (code >> np.uint64(32)).astype(np.int64) % RADIX
        for k in range(RADIX):
            held = radix == k
            if held.any():
                mine = held[pair]
                place = np.cumsum(held) - 1
                yield k, packed(code[held], total[held]), packed(place[pair[mine]], row[mine], times[mine])


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of one B id after another, over all ``runs`` (pairs,
    counts): a heap holds the B id at the head of each run."""
    held, heap = [], []
    for k, run in enumerate(runs):
        code, n = unpacked(run, 2)
        side = code >> 32
        cut = starts(side)
        held.append((code, n, side[cut].tolist(), [*cut.tolist(), len(code)]))
        if len(cut):
            heap.append((held[k][2][0], k, 0))
    heapq.heapify(heap)
    while heap:
        side, parts = heap[0][0], []
        while heap and heap[0][0] == side:
            _, k, at = heap[0]
            code, n, sides, cut = held[k]
            parts.append((code[cut[at] : cut[at + 1]], n[cut[at] : cut[at + 1]]))
            if at + 1 < len(sides):
                heapq.heapreplace(heap, (sides[at + 1], k, at + 1))
            else:
                heapq.heappop(heap)
        code, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        code, where = np.unique(code, return_inverse=True)
        total = np.zeros(len(code), np.int64)
        np.add.at(total, where, n)
        yield code, total


def _merge(final: bool):
    """Of the runs of a group one run; the last one says which counts are the highest of their B id."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        columns = list(zip(*((c, n, n == n.max()) for c, n in merged(table.column("pairs").to_pylist())), strict=True))
        columns = [np.concatenate(x) for x in columns]
        one = packed(*columns) if final else packed(*columns[:2])
        out = {"radix": pa.array([key[0].as_py()], pa.int32())}
        if not final:
            out["lot"] = pa.array([key[1].as_py()], pa.int32())
        return pa.table(out | {"pairs": pa.array([one], pa.binary())})

    return run


# ------------------------------------------------------------------- operator

ENCODED = (
    "block long, row int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, "
    "radix int, pairs binary, records binary"
)
TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
ARROW = pa.schema([(c.split()[0], TYPES[c.split()[1]]) for c in ENCODED.split(", ")])


def _rows(columns: dict[str, list], many: int) -> pa.RecordBatch:
    """A batch of ``ENCODED``, null where ``columns`` has nothing."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, [None] * many), f.type) for f in ARROW], schema=ARROW
    )


def _encoded(docs: DataFrame, a_file: str, b_file: str, groups: bool) -> DataFrame:
    """One row for each document and one for each run of a block."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = aligner(a_file, b_file)
        gc.disable()  # units make no cycles, and there are very many
        task = TaskContext.get().partitionId()
        number, block_runs, ids = 0, BlockRuns(), []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, block_runs, ids
            block = task << 32 | number
            if ids:
                columns = {"block": [block] * len(ids), "row": list(range(len(ids))), "doc_id": ids} | block_runs.lines(groups)
                yield _rows(columns, len(ids))
            for radix, pairs, records in block_runs.runs():
                yield _rows({"block": [block], "radix": [radix], "pairs": [pairs], "records": [records]}, 1)
            number, block_runs, ids = number + 1, BlockRuns(), []

        for batch in batches:
            told, texts = batch.column(0).to_pylist(), text_array(batch)
            at = 0
            while at < len(told):
                chunk, size = [], 0
                while at + len(chunk) < len(told) and size < CHUNK_CHARS:
                    chunk.append(texts[at + len(chunk)].as_py())
                    size += len(chunk[-1])
                for text, cut in zip(chunk, code.parts(chunk, block_runs.number, block_runs.units), strict=True):
                    block_runs.add(cut, len(text))
                ids += told[at : at + len(chunk)]
                if block_runs.text >= BLOCK_TEXT:
                    yield from flush()
                at += len(chunk)
                code.forget()
        yield from flush()
        code.older, code.known = {}, {}
        code.broken.clear()
        gc.enable()
        give_back(keep=True)

    return docs.mapInArrow(encode, ENCODED)


def _lot(of: str, lots: int):
    return F.pmod(F.xxhash64(of), F.lit(lots)).cast("int").alias("lot")


def _runs(encoded: DataFrame) -> tuple[DataFrame, int]:
    """Runs in lots of about ``FAN``, and the number of lots."""
    blocks = encoded.select("block").distinct().count()
    lots = max(1, -(-blocks // FAN))
    return encoded.where("radix is not null").select("block", "radix", _lot("block", lots), "pairs"), lots


def _counts(runs: DataFrame, lots: int) -> DataFrame:
    """(radix, pairs): all pairs with their count and whether it is the
    highest of the B id, after as many rounds of merging as there must be."""
    runs = runs.select("radix", "lot", "pairs")
    while lots > 1:
        lots = -(-lots // FAN)
        runs = runs.groupBy("radix", "lot").applyInArrow(_merge(False), "radix int, lot int, pairs binary")
        runs = runs.select("radix", _lot("lot", lots), "pairs")
    return runs.groupBy("radix").applyInArrow(_merge(True), "radix int, pairs binary")


def _back(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each run the counts of its pairs and whether they are the highest."""
    block, radix, found = [], [], []
    if left.num_rows:
        code, total, best = unpacked(right.column("pairs")[0].as_py(), 3)
        for b, r, pairs in zip(*(left.column(c).to_pylist() for c in ("block", "radix", "pairs")), strict=True):
            at = np.searchsorted(code, unpacked(pairs, 2)[0])
            block.append(b)
            radix.append(r)
            found.append(packed(total[at], best[at]))
    return pa.table({
        "block": pa.array(block, pa.int64()), "radix": pa.array(radix, pa.int32()), "counts": pa.array(found, pa.binary())
    })


def _added(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with what their records add up to."""
    told = pa.compute.is_null(left.column("radix"))
    docs, runs = left.filter(told), left.filter(pa.compute.invert(told))
    row = docs.column("row").to_numpy()
    sums = np.zeros((3, int(row.max()) + 1 if len(row) else 0), np.int64)  # links, best ones, counts
    counts = dict(zip(right.column("radix").to_pylist(), right.column("counts").to_pylist(), strict=True))
    for radix, records in zip(runs.column("radix").to_pylist(), runs.column("records").to_pylist(), strict=True):
        total, best = unpacked(counts[radix], 2)
        pair, doc, times = unpacked(records, 3)
        for k, weight in enumerate((1, best[pair], total[pair])):
            np.add.at(sums[k], doc, times * weight)
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")}
    out |= {c: pa.array(sums[k][row]) for k, c in enumerate(("n_links", "n_best", "count_sum"))}
    return pa.table(out | {c: docs.column(c) for c in ("groups_sha256", "groups")})


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


def alignments(
    df: DataFrame, a_file: str, b_file: str, groups: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and
    ``groups`` (``a1,a2|b1;a3|b2,b3``; null unless ``groups``) for every row."""
    encoded = checkpoint(_encoded(documents(df, id_col, text_col), a_file, b_file, groups))
    runs, lots = _runs(encoded)
    table = _counts(runs, lots).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    back = runs.groupBy("radix", "lot").cogroup(table.groupBy("radix", "lot")).applyInArrow(
        _back, "block long, radix int, counts binary"
    )
    return encoded.drop("pairs").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_added, RESULT)


def pair_counts(
    df: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(a, b, n, best): every linked id pair, how many links hold it, and
    whether no other pair of the B id has more."""
    encoded = checkpoint(_encoded(documents(df, id_col, text_col), a_file, b_file, False))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.column(1).to_pylist():
                code, total, best = unpacked(run, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code & 0xFFFFFFFF), pa.array(code >> 32), pa.array(total), pa.array(best == 1)],
                    ["a", "b", "n", "best"],
                )

    return _counts(*_runs(encoded)).mapInArrow(listed, "a long, b long, n long, best boolean")
