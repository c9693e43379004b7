"""Operator 11 against whole texts encoded by both libraries and plain counting."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from aerolens.llm import token_alignment
from aerolens.llm.byte_bpe import byte_alphabet
from llm_helpers import AWKWARD, awkward, expected_ids, ids, nothing

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [
    "a", "B", "the", " ", "  ", "\n", "\r", "\t", ";\r", "}", "é", "🎉", "中", "\x00", "\x1c", "　", "1", "23", "'s",
    "<|endoftext|>", "<s>", "<0x41>", "word", "\x85", "ing", " The", "👩‍👩", "ं", "()", "▁",
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.entry = {k: e for e, k in self.a.get_vocab().items()}
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}

    def of_b(self, k):
        piece = self.b.id_to_piece(k)
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ends(self, tokens):
        return np.cumsum([len(t) for t in tokens]).tolist()

    def encode(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [bytes(self.byte[c] for c in self.entry[k]) for k in a]
        b_bytes = [self.of_b(k) for k in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        a_ends, b_ends = self.ends(a_bytes), self.ends(b_bytes)
        place = {e: k for k, e in enumerate(b_ends)}
        links, said, i, j = [], [], 0, 0
        for k, e in enumerate(a_ends):
            if e in place:
                m = place[e]
                links.append((a[k], b[m]))
                said.append(",".join(map(str, a[i : k + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
                i, j = k + 1, m + 1
        return len(a), len(b), links, ";".join(said)

    def results(self, rows):
        encoded = [(i, self.encode(t)) for i, t in rows]
        count = Counter(link for _, e in encoded if e for link in e[2])
        top = {}
        for (_, b), n in count.items():
            top[b] = max(top.get(b, 0), n)
        out = []
        for i, e in encoded:
            if e is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, links, said = e
            out.append((
                i, n_a, n_b, said.count(";") + 1, len(links), sum(count[x] == top[x[1]] for x in links),
                sum(count[x] for x in links), hashlib.sha256(said.encode()).hexdigest(),
            ))
        return out, count, top


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


def found(frame):
    return sorted((tuple(r) for r in frame.drop("groups").collect()), key=key)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_random_texts_equal_whole_encoding(spark, plain, monkeypatch):
    rnd = random.Random(11)
    rows = [(k // 2, "".join(rnd.choice(PARTS[: 30 - k % 2]) for _ in range(rnd.randint(0, 25)))) for k in range(1500)]
    rows += [(None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, count, top = plain.results(rows)
    assert found(token_alignment.alignments(df, A, B)) == sorted(want, key=key)
    pairs = token_alignment.pair_counts(df, A, B).collect()
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs} == {x: (n, n == top[x[1]]) for x, n in count.items()}


def test_documents_equal_whole_encoding(spark, plain):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want, _, _ = plain.results([tuple(r) for r in df.collect()])
    assert found(token_alignment.alignments(df, A, B, groups=False)) == sorted(want, key=key)


def test_many_lots_are_merged_in_rounds(spark, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "FAN", 2)  # read on the driver
    rows = [(k, f"the {k % 7} words of number {k} stand here") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    want, _, _ = plain.results(rows)
    assert found(token_alignment.alignments(df, A, B)) == sorted(want, key=key)


def test_groups_are_whole_texts(spark, plain):
    rows = [(1, "Overlapping tokenizations  disagree\n\nhere"), (2, "x▁y"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["groups"] for r in token_alignment.alignments(df, A, B).collect()}
    assert got == {1: plain.encode(rows[0][1])[3], 2: "", 3: ""}


def test_awkward_rows(spark, plain):
    got = token_alignment.alignments(awkward(spark), A, B)
    assert ids(got) == expected_ids()
    want, _, _ = plain.results([(i, t) for i, t, *_ in AWKWARD])
    assert found(got) == sorted(want, key=key)
    assert token_alignment.alignments(nothing(spark), A, B).collect() == []


def test_packed_columns_come_back():
    columns = [np.array([3, 3, 9, 1 << 60]), np.array([-5, 0, 7, 7])]
    assert [c.tolist() for c in token_alignment.unpacked(token_alignment.packed(*columns), 2)] == [c.tolist() for c in columns]
    assert [len(c) for c in token_alignment.unpacked(token_alignment.packed(np.zeros(0), np.zeros(0)), 2)] == [0, 0]
