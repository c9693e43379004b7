"""Exact byte-substring dedup by suffix arrays (operator 5).

Every text is UTF-8 bytes; a byte goes if a string of ``length`` bytes that
covers it also starts in a document with a smaller id. Strings are judged on
the input, matches never cross documents. ``repeats`` narrows the corpus down
to the passages that share an anchor but differ; those of a bucket are sorted
by a two-stage suffix sort, and adjacent common prefixes of at least
``length`` bytes tell which strings are the same.

Null texts count as empty. A null id counts as larger than any id. Documents
of equal ids aren't smaller than each other, so neither loses bytes to the
other; each row gives a row. An empty table gives no rows, a very long text is
hashed whole (some 60 bytes of memory for each of its own), other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolens.llm.common import Block, byte_values, documents
from aerolens.llm.repeats import Passages, without_repeats


def _keys(text: np.ndarray, length: int) -> np.ndarray:
    """For each position the first ``length`` bytes from there (zeros beyond
    the end) as rows of big-endian 64-bit integers."""
    n, words = len(text), -(-length // 8)
    padded = np.concatenate((text, np.zeros(8 * words + 8, np.uint8))).astype(np.uint64)
    eight, size = padded, 1
    while size < 8:
        eight = eight[:-size] << np.uint64(8 * size) | eight[size:]
        size *= 2
    out = np.empty((words, n), np.uint64)
    for k in range(words):
        out[k] = eight[8 * k : 8 * k + n]
    out[-1] >>= np.uint64(8 * (8 * words - length))
    return out


def suffix_order(text: np.ndarray, length: int, keys: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``text`` (bytes) sorted by the suffix from there, as far as
    its first ``length`` bytes tell; two-stage sort.

    Stage one sorts only the suffixes smaller than their successors. Stage two
    scans the buckets of first bytes from small to large: whenever a suffix is
    met whose predecessor is larger than its own successor, the predecessor is
    next in its bucket's front part. Whole buckets are scanned at a time; a
    bucket is taken up again for runs of its own byte."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    keys = _keys(text, length) if keys is None else keys
    # Type of each suffix: that of the next position with another byte decides.
    differs = np.flatnonzero(text[:-1] != text[1:])
    ahead = np.searchsorted(differs, np.arange(n))
    smaller = np.zeros(n, bool)
    inside = ahead < len(differs)
    turn = differs[ahead[inside]]
    smaller[inside] = text[turn] < text[turn + 1]

    direct = np.flatnonzero(smaller)
    direct = direct[np.lexsort(tuple(keys[k, direct] for k in range(len(keys) - 1, -1, -1)))]
    limits = np.searchsorted(text[direct], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    fronts[int(text[-1])].append(np.array([n - 1]))  # follows the empty suffix, the smallest

    def induce(now: np.ndarray, c: int) -> np.ndarray:
        """Passes on the predecessors; returns those of the same bucket."""
        before = now[now > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        same = before[first == c]
        before, first = before[first > c], first[first > c]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        if len(before):
            cut = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for a, b in zip(cut, [*cut[1:], len(before)], strict=True):
                fronts[int(first[a])].append(before[a:b])
        return same

    out = []
    for c in range(256):
        now = np.concatenate(fronts[c]) if fronts[c] else np.zeros(0, np.int64)
        while len(now):
            out.append(now)
            now = induce(now, c)
        back = direct[limits[c] : limits[c + 1]]
        if len(back):
            out.append(back)
            induce(back, c)
    return np.concatenate(out)


def held_by_smaller(length: int):
    """For passages with document ids: those strings of ``length`` bytes that
    a passage of a smaller id holds as well, as (passage, start)."""

    def compare(texts: list[bytes], ids: np.ndarray, _status: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        first = np.concatenate(([0], np.cumsum(sizes + 1)))
        keys = _keys(text, length)
        order = suffix_order(text, length, keys)
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        order = order[order + length <= first[owner[order] + 1] - 1]  # whole strings
        if not len(order):
            return order, order
        # Adjacent common prefixes: whether they reach ``length``.
        alike = np.ones(len(order) - 1, bool)
        for k in keys:
            held = k[order]
            alike &= held[1:] == held[:-1]
        cut = np.flatnonzero(np.concatenate(([True], ~alike)))
        held = ids[owner[order]]
        least = np.repeat(np.minimum.reduceat(held, cut), np.diff(np.concatenate((cut, [len(order)]))))
        hit = order[held > least]
        return owner[hit], hit - first[owner[hit]]

    return compare


def _byte_units(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return byte_values(block.data), block.ends


def _byte_cutter(text: bytes):
    return lambda start, end: text[start:end]


def suffix_dedup(
    df: DataFrame, length: int = 50, gram: int = 18, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed bytes, end exclusive), kept
    (the remaining bytes) and kept_sha256, for every row of ``df``."""
    schema = (
        "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, "
        "kept binary, kept_sha256 string"
    )
    return _deduped(df, length, gram, id_col, text_col, schema)


def suffix_dedup_digest(
    df: DataFrame, length: int = 50, gram: int = 18, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As ``suffix_dedup``, with the number of spans in place of spans and bytes."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _deduped(df, length, gram, id_col, text_col, schema)


def _deduped(df: DataFrame, length: int, gram: int, id_col: str, text_col: str, schema: str) -> DataFrame:
    passages = Passages(length, gram, _byte_units, _byte_cutter, True, held_by_smaller(length))
    return without_repeats(documents(df, id_col, text_col), passages, _kept("kept binary" in schema), schema)


def _kept(full: bool):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def finish(texts: list[str], runs: list[np.ndarray]) -> dict[str, pa.Array]:
        n, gone, kept, digest = [], [], [], []
        for whole, own in zip(texts, runs, strict=True):
            text, parts, at = whole.encode(), [], 0
            for _, start, end in own.tolist():
                parts.append(text[at:start])
                at = end
            left = b"".join([*parts, text[at:]])
            n.append(len(text))
            gone.append(len(text) - len(left))
            digest.append(hashlib.sha256(left).hexdigest())
            if full:
                kept.append(left)
        out = {
            "n_bytes": pa.array(n, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "n_spans": pa.array([len(r) for r in runs], pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        }
        if full:
            out["spans"] = pa.array([[{"start": s, "end": e} for _, s, e in r.tolist()] for r in runs], pa.list_(span))
            out["kept"] = pa.array(kept, pa.binary())
        return out

    return finish
