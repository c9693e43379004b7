"""Frames with every awkward case, and plain versions of what operators share."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Texts of the awkward frame, by id; some ids stand twice, one is null.
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(12_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "b"),
    (4, " \t\r\n ", "en", "b"),
    (None, "the quick brown fox jumps over the lazy dog near the river bank today", None, None),
    (None, None, None, None),
    (5, LONG, "en", "c"),
    (6, LONG + " end", "en", "c"),
    (6, "another text under the same id, rather short", "en", "c"),
    (7, "1234 5678 !!! ???", "en", "d"),
    (8, "ſecret K naïve façade  🎉 \x00 null byte", "fr", "d"),
]


def awkward(spark):
    """Documents with nulls, repeats, long texts, and columns named like results."""
    rows = [(i, t, lang, src, None if t is None else len(t), -1, "x", -1.0) for i, t, lang, src in AWKWARD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, rid long, lines string, score double",
    )


def nothing(spark):
    return awkward(spark).limit(0)


def ids(frame, column="doc_id"):
    return sorted((r[column] is None, r[column] or 0) for r in frame.select(column).collect())


def expected_ids():
    return sorted((i is None, i or 0) for i, *_ in AWKWARD)


class Groups:
    """Union-find that keeps the smallest member as root."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
