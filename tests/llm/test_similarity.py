"""MinHash (1), embeddings (7), lines (8) and their shared parts."""

import collections
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolens.llm import embedding_forest, line_dedup, linking, minhash_dedup
from aerolens.llm.common import components
from llm_helpers import LOWER, WORD, Groups

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)]  # a long chain
    edges += [(1000, 1000 + i) for i in range(1, 400)]  # a hot centre
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(5000, 5000)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: groups.root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -------------------------------------------------------------------- MinHash


def near_copies():
    """Copies of one text with few to many words changed, exact copies, and
    texts that share much but not enough."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=7))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(260):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = word()
        rows.append(" ".join(own))
    for i in range(40):  # changed the same way by twos
        own = list(base)
        r = random.Random(i // 2)
        for _ in range(12):
            own[r.randrange(len(own))] = f"same{r.random()}"
        rows.append(" ".join(own).upper())
    rows += [rows[3]] * 5 + ["one two three", "one  two\tthree", "one two four", "x", ""]
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


def expected_groups(rows, size, share):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    groups = Groups(sets)
    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.root(i), groups.root(i) == i) for i in sets}


@pytest.mark.parametrize("block", [1500, 7])
def test_minhash_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_ITEMS", block)
    monkeypatch.setattr(linking, "HUB_MEETINGS", 5 * block)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in minhash_dedup.near_duplicates(docs).collect()}
    want = expected_groups(rows, 4, 80)
    assert got == want
    sizes = collections.Counter(root for _, root, _ in want.values())
    assert max(sizes.values()) > 100 and len(sizes) > 20
    kept = {r["doc_id"] for r in minhash_dedup.one_of_each(docs, shingle=5).collect()}
    assert kept == {i for i, x in expected_groups(rows, 5, 80).items() if x[2]}


def test_one_of_each_group_stays(spark):
    def text(name, changed=""):
        return " ".join([f"{name}{k}" for k in range(60)] + [changed])

    rows = [
        (1, text("a"), "q"), (1, text("a"), "p"), (1, text("a"), "p"),  # rows repeated
        (2, text("b"), "p"), (2, text("b", "x"), "p"), (2, text("b", "y"), "p"),  # near copies under one id
        (None, text("c"), "p"), (None, text("c"), "p"), (None, text("c", "x"), "p"),  # no id in the group
        (None, text("d"), "p"), (9, text("d", "x"), "p"), (9, text("d", "x"), "p"), (4, text("e"), "p"),
        (5, None, "p"), (5, None, "p"), (6, "", "p"), (6, "", "p"),  # no words: in no group
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string").repartition(3)
    out = minhash_dedup.one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert set(got) <= set(rows)
    groups = collections.Counter((r[1] or "")[:1] for r in got)
    assert groups == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1, "": 4}
    assert rows[1] in got and rows[10] in got


def test_minhash_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == expected_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 80)


def test_min_and_max_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    share = []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.concatenate((both, rng.integers(0, 1 << 63, 50, dtype=np.uint64))) for _ in range(2))
        share.append((minhash_dedup.signature(a) == minhash_dedup.signature(b)).mean())
    assert abs(np.mean(share) - 0.8) < 0.01


# ----------------------------------------------------------------- embeddings


def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(48), int(i % 3)) for i in range(900)]
    centres = rng.standard_normal((25, 48))
    rows += [(1000 + i, centres[i % 25] + rng.standard_normal(48) * 0.15, int(i % 2)) for i in range(500)]
    tight = rng.standard_normal(48)
    rows += [(2000 + i, tight + rng.standard_normal(48) * 0.02, 0) for i in range(320)]
    rows += [(3000 + i, tight, 0) for i in range(40)]
    return [(i, v.astype(np.float32).tolist(), label) for i, v, label in rows]


def expected_links(rows, least=0.93):
    n, groups = collections.Counter(), Groups([r[0] for r in rows])
    for label in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == label]
        v = np.array([r[1] for r in own], np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(v @ v.T >= least, 1))):
            n[own[a][0]] += 1
            n[own[b][0]] += 1
            groups.join(own[a][0], own[b][0])
    return {r[0]: (n[r[0]], groups.root(r[0]), groups.root(r[0]) == r[0]) for r in rows}


@pytest.mark.parametrize("part_rows", [20_000, 100])
def test_forest_recall(spark, part_rows, monkeypatch):
    monkeypatch.setattr(embedding_forest, "PART_ROWS", part_rows)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r[0]: tuple(r)[1:] for r in embedding_forest.close_vectors(frame, leaf_rows=64).collect()}
    want = expected_links(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    found, there = (sum(x[0] for x in y.values()) for y in (got, want))
    assert there > 100_000 and found >= 0.99 * there
    assert sum(got[i][1:] == want[i][1:] for i in want) >= 0.99 * len(want)


def near_vectors(rows, size=64, mean=0.95):
    """Distinct noisy copies of one vector, with that mean cosine."""
    rng = np.random.default_rng(11)
    unit = rng.standard_normal((1, size)) / np.sqrt(size)
    noise = rng.standard_normal((rows, size)) * np.sqrt((1 / mean - 1) / size)
    found = unit / np.linalg.norm(unit) + noise
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def test_dense_vectors_are_not_split_into_ever_more_leaves():
    placed = [len(rows) for rows in embedding_forest.leaves(near_vectors(4000), 0, 0.93, 256)]
    assert sum(placed) <= 2 * 4000 and sum(n * n for n in placed) <= 4000 * 4000


@pytest.mark.parametrize("part_rows, block_rows", [(20_000, 4000), (20_000, 300), (200, 300)])
def test_dense_group_without_its_pairs(spark, part_rows, block_rows, monkeypatch):
    monkeypatch.setattr(embedding_forest, "PART_ROWS", part_rows)
    monkeypatch.setattr(embedding_forest, "BLOCK_ROWS", block_rows, raising=False)
    monkeypatch.setattr(embedding_forest, "TILE", 128, raising=False)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(near_vectors(1500))]
    rows += [(5000 + i, rows[i][1], 0) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    sent, keep = [], embedding_forest.checkpoint
    monkeypatch.setattr(embedding_forest, "checkpoint", lambda f: (sent.append(keep(f)), sent[-1])[1])
    got = {r[0]: tuple(r)[1:] for r in embedding_forest.close_vectors(frame).collect()}
    assert max(f.count() for f in sent) < 100_000
    want = expected_links(rows)
    there = sum(x[0] for x in want.values())
    assert there > 1_500_000 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.999 * there
    assert {i: x[1:] for i, x in got.items()} == {i: x[1:] for i, x in want.items()}


def test_forest_edges(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [float("inf"), 1.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, None), (12, [-0.0, 1.0], 3),
        (13, [0.0, 1.0], 3),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rid", "2 AS node")
    got = sorted((tuple(r) for r in embedding_forest.close_vectors(frame).collect()), key=str)
    linked = {(1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False), (12, 1, 12, True), (13, 1, 12, False)}
    alone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)} | {(None, 0, None, True)}
    assert set(got) == linked | alone and len(got) == len(rows)
    assert embedding_forest.close_vectors(frame.limit(0)).collect() == []


# ---------------------------------------------------------------------- lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


edits = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.sampled_from("abc")), max_size=4)


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=30), edits, st.integers(0, 3))
def test_banded_distance(a, changes, most):
    b = list(a)
    for kind, at, c in changes:
        at = min(at, len(b))
        if kind == 0:
            b.insert(at, c)
        elif at < len(b):
            b[at : at + 1] = [] if kind == 1 else [c]
    b = "".join(b)
    assert line_dedup.within(a, b, most) == (distance(a, b) <= most)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=4, max_size=30), edits.map(lambda x: x[:2]))
def test_close_lines_meet_in_the_index(a, changes):
    b = list(a)
    for kind, at, c in changes:
        at = min(at, len(b))
        if kind == 0:
            b.insert(at, c)
        elif at < len(b):
            b[at : at + 1] = [] if kind == 1 else [c]
    short, long = sorted((a, "".join(b)), key=len)
    index = {(len(short), k, short[s : s + n]) for k, (s, n) in enumerate(line_dedup.segments(len(short), 3))}
    probes = {(n, k, long[s : s + size]) for n, k, s, size in line_dedup.probes(len(long), 2)}
    assert index & probes


def lines():
    rng = random.Random(8)
    rows = []
    base = ["".join(rng.choices("abcdefgh ", k=rng.randrange(12, 60))) for _ in range(150)]
    for i in range(300):
        own = []
        for _ in range(rng.randrange(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                line[rng.randrange(len(line))] = rng.choice("abcdefghé🎉")
            own.append(" " * rng.randrange(2) + "".join(line) + rng.choice(["", "\t", "\r"]))
        rows.append((i, "\n".join(own)))
    rows += [(1000 + i, f"Page {i:03d} of the very same document\n\nx") for i in range(200)]  # a hot template
    return rows


def expected_lines(rows, edits=2, least=16):
    places = collections.defaultdict(list)
    for i, t in sorted(rows):
        for k, x in enumerate(t.split("\n")):
            if len(x.strip(line_dedup.BLANKS)) >= least:
                places[x.strip(line_dedup.BLANKS)].append((i, k))
    texts = sorted(places, key=len)
    groups = Groups(texts)
    for n, a in enumerate(texts):
        for b in texts[n + 1 :]:
            if len(b) - len(a) > edits:
                break
            if groups.root(a) != groups.root(b) and line_dedup.within(a, b, edits):
                groups.join(a, b)
    first = {}
    for x in texts:
        root = groups.root(x)
        first[root] = min(first.get(root, (1 << 60, 0)), places[x][0])
    gone = collections.defaultdict(list)
    for x in texts:
        for place in places[x]:
            if place != first[groups.root(x)]:
                gone[place[0]].append(place[1])
    return {i: sorted(gone[i]) for i, _ in rows}


@pytest.mark.parametrize("block", [1500, 10])
def test_lines_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_ITEMS", block)
    rows = lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = line_dedup.line_dedup(docs).collect()
    want = expected_lines(rows)
    assert {r["doc_id"]: list(r["removed"]) for r in got} == want
    assert sum(map(len, want.values())) > 500
    for r in got:
        left = [x for k, x in enumerate(r["text"].split("\n")) if k not in set(want[r["doc_id"]])]
        assert r["kept"] == "\n".join(left)


def test_documents_of_repeated_lines_go(spark):
    rows = [(1, "a line that stands here first\nshort", "p"), (2, "a line that stands here first", "q"),
            (3, "a line that stands here first\nshort", "r"), (4, "", "s"), (5, None, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {tuple(r) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got == {rows[0], (3, "short", "r"), rows[3], rows[4]}
