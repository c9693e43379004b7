"""Repeated-passage removal by relative Lempel-Ziv parsing (operator 4).

Words are runs of bytes other than blanks, unchanged. A word goes if a window
of ``length`` consecutive words that covers it also starts anywhere else, in
the same document or another; all copies go, windows are judged on the input.
``repeats`` narrows the corpus down to passages that share an anchor but
differ. In each bucket those passages are the reference: it is indexed by its
windows, and every passage is factored greedily against all of it but itself.
A factor of ``length`` words or more is a repeated span. Where a factor ends,
the windows across its end are looked up as well, since a greedy factor can
hide a longer one that starts inside it.

Null texts have no words. Null or repeated ids don't matter: every row is a
place of its own, so repeated rows remove each other. Each row gives a row. An
empty table gives no rows, a very long text is hashed whole (some 60 bytes of
memory for each of its own), other columns are not read. There are no ties: a
window that occurs twice goes in both places.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolens.llm.common import NOT_BLANK, Block, documents, words
from aerolens.llm.repeats import COMPARE, Passages, without_repeats

#: Fixed value: the contract's word.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Reference:
    """Passages of words, indexed by every window of ``length`` words."""

    def __init__(self, passages: list[list[bytes]], length: int):
        self.passages, self.length = passages, length
        self.places: dict[bytes, list[tuple[int, int]]] = {}
        for k, own in enumerate(passages):
            for at in range(len(own) - length + 1):
                # Two places are enough to tell that a window stands elsewhere too.
                lot = self.places.setdefault(self.window(own, at), [])
                if len(lot) < 2:
                    lot.append((k, at))

    def window(self, own: list[bytes], at: int) -> bytes:
        return b" ".join(own[at : at + self.length])

    def factor(self, k: int, at: int) -> int:
        """Words of the longest match found for passage ``k`` from ``at`` on at
        another place; 0 if shorter than a window."""
        own, longest = self.passages[k], 0
        for other, start in self.places.get(self.window(own, at), ()):
            if (other, start) == (k, at):
                continue
            there, n = self.passages[other], self.length
            while at + n < len(own) and start + n < len(there) and own[at + n] == there[start + n]:
                n += 1
            longest = max(longest, n)
        return longest

    def parse(self, k: int) -> list[tuple[int, int]]:
        """Long factors of passage ``k`` as (start, end)."""
        own, found, at = self.passages[k], [], 0
        last = len(own) - self.length
        while at <= last:
            n = self.factor(k, at)
            if not n:
                at += 1
                continue
            end = at + n
            found.append((at, end))
            # Windows across the factor's end, up to where the next factor starts.
            for start in range(max(at + 1, end - self.length + 1), min(end, last + 1)):
                more = self.factor(k, start)
                if more:
                    found.append((start, start + more))
            at = end
        return found


def held_elsewhere(length: int):
    """For passages of words: the windows that stand elsewhere as well, as
    (passage, start)."""

    def compare(texts: list[bytes], _ids: np.ndarray, status: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        reference = Reference([t.split(b" ") for t in texts], length)
        hits = [
            (k, at)
            for k in np.flatnonzero(status == COMPARE).tolist()
            for start, end in reference.parse(k)
            for at in range(start, end - length + 1)
        ]
        found = np.array(hits, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    return compare


def _word_units(block: Block) -> tuple[np.ndarray, np.ndarray]:
    found = words(block, NOT_BLANK)
    return found.hash, found.first


def _word_cutter(text: bytes):
    own = WORD.findall(text)
    return lambda start, end: b" ".join(own[start:end])


def substring_dedup(
    df: DataFrame, length: int = 35, gram: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, end exclusive), kept
    (the other words joined by single spaces) and kept_sha256 for every row."""
    schema = (
        "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, "
        "kept string, kept_sha256 string"
    )
    return _deduped(df, length, gram, id_col, text_col, schema)


def substring_dedup_digest(
    df: DataFrame, length: int = 35, gram: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As ``substring_dedup`` without spans and texts."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _deduped(df, length, gram, id_col, text_col, schema)


def _deduped(df: DataFrame, length: int, gram: int, id_col: str, text_col: str, schema: str) -> DataFrame:
    passages = Passages(length, gram, _word_units, _word_cutter, False, held_elsewhere(length))
    return without_repeats(documents(df, id_col, text_col), passages, _kept("kept string" in schema), schema)


def _kept(full: bool):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def finish(texts: list[str], runs: list[np.ndarray]) -> dict[str, pa.Array]:
        n, gone, kept, digest = [], [], [], []
        for text, found in zip(texts, runs, strict=True):
            own = WORD.findall(text.encode())
            left, at = [], 0
            for _, start, end in found.tolist():
                left += own[at:start]
                at = end
            left += own[at:]
            joined = b" ".join(left)
            n.append(len(own))
            gone.append(len(own) - len(left))
            digest.append(hashlib.sha256(joined).hexdigest())
            if full:
                kept.append(joined.decode())
        out = {
            "n_words": pa.array(n, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        }
        if full:
            out["spans"] = pa.array([[{"start": s, "end": e} for _, s, e in r.tolist()] for r in runs], pa.list_(span))
            out["kept"] = pa.array(kept, pa.string())
        return out

    return finish
