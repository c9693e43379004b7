"""Passage operators (4, 5) against brute force, and their parts by property."""

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolens.llm import repeats, substring_rlz, suffix_dedup
from aerolens.llm.common import byte_values
from llm_helpers import WORD

SF = "/root/testdata/sf0.001"


def planted(spark):
    """The small table and a passage that a third of 600 more documents hold,
    each between words of its own."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = " ".join(word() for _ in range(60))
    short = " ".join(word() for _ in range(12))
    rows = []
    for i in range(600):
        own = [word() for _ in range(rng.randrange(0, 80))]
        middle = passage if i % 3 == 0 else short if i % 3 == 1 else ""
        rows.append((10_000 + i, " ".join([*own, middle, *(word() for _ in range(40))])))
    rows += [(20_000, (passage + " ") * 40), (20_001, "x" * 5000), (20_002, "ab " * 3000)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.union(spark.createDataFrame(rows, "doc_id long, text string")).repartition(5).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return planted(spark)


def removed_words(rows, length):
    count, words = collections.Counter(), {}
    for i, t in rows:
        w = words[i] = WORD.findall(t or "")
        count.update(tuple(w[k : k + length]) for k in range(len(w) - length + 1))
    out = {}
    for i, w in words.items():
        gone = [0] * len(w)
        for k in range(len(w) - length + 1):
            if count[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = [1] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def removed_bytes(rows, length):
    first = {}
    texts = {i: (t or "").encode() for i, t in sorted(rows)}
    for i, b in texts.items():
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    out = {}
    for i, b in texts.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4000, 3])
def test_words_equal_brute_force(docs, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_CLASSES", hot)
    want = removed_words([tuple(r) for r in docs.collect()], 35)
    got = {r[0]: tuple(r)[1:] for r in substring_rlz.substring_dedup_digest(docs).collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 10_000


@pytest.mark.parametrize("hot", [4000, 3])
def test_bytes_equal_brute_force(docs, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_CLASSES", hot)
    want = removed_bytes([tuple(r) for r in docs.collect()], 50)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.suffix_dedup_digest(docs).collect()}
    assert got == want and sum(n for _, n, _, _ in want.values()) > 50_000


def test_small_flushes_give_the_same(docs, monkeypatch):
    monkeypatch.setattr(repeats, "FLUSH", 200)
    want = removed_words([tuple(r) for r in docs.collect()], 35)
    got = {r[0]: tuple(r)[1:] for r in substring_rlz.substring_dedup_digest(docs).collect()}
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=150), st.text("ab\0", max_size=200).map(str.encode)), st.sampled_from([1, 7, 8, 9, 50]))
def test_suffix_order(text, length):
    order = suffix_dedup.suffix_order(np.frombuffer(text, np.uint8), length)
    keys = [(text[i : i + length] + b"\0" * length)[:length] for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", max_size=60).map(str.encode), min_size=1, max_size=6))
def test_rlz_finds_every_repeated_window(texts):
    passages = [[bytes([c]) for c in t] for t in texts]
    reference = substring_rlz.Reference(passages, 4)
    places = collections.Counter(t[k : k + 4] for t in texts for k in range(len(t) - 3))
    for n, t in enumerate(texts):
        found = {k for s, e in reference.parse(n) for k in range(s, e - 3)}
        assert found == {k for k in range(len(t) - 3) if places[t[k : k + 4]] > 1}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=120), min_size=1, max_size=4))
def test_anchored_blocks_cover_every_window_once(texts):
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    values = byte_values(np.frombuffer(b"".join(texts), np.uint8))
    row, start, size, _, content = repeats.anchored(values, first, 20, 6)
    windows = sorted((r, k) for r, s, n in zip(row, start, size) for k in range(s, s + n - 19))
    assert windows == [(r, k) for r, t in enumerate(texts) for k in range(len(t) - 19)]
    by_text = collections.defaultdict(set)
    for r, s, n, c in zip(row, start, size, content):
        by_text[texts[r][s : s + n]].add(int(c))
    assert all(len(x) == 1 for x in by_text.values())
    assert len({c for x in by_text.values() for c in x}) == len(by_text)
