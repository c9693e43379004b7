"""Operator 12 against Lloyd's rounds with all distances computed."""

import math

import numpy as np
import pytest

from aerolens.llm import vector_codes
from aerolens.llm.vector_codes import Books, assign, cover_trees

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int"


def plain(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label) -> (id, code, error, label_error) and codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], []
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in kept]
    length = len(whole[0])
    cut = [k * length // parts for k in range(parts + 1)]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[whole[k][cut[p] : cut[p + 1]] for k in order] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            lots = {}
            for v in whole:
                x = v[cut[p] : cut[p + 1]]
                lots.setdefault(nearest(p, x)[1], []).append(x)
            moved = {k: [sum(c) // len(lot) for c in zip(*lot)] for k, lot in lots.items()}
            books[p] = [moved.get(k, e) for k, e in enumerate(books[p])]
    found, sums = [], {}
    for (i, _, label), v in zip(kept, whole):
        each = [nearest(p, v[cut[p] : cut[p + 1]]) for p in range(parts)]
        error = sum(d for d, _ in each)
        sums[label] = sums.get(label, 0) + error
        found.append((i, "".join(f"{k:02x}" for _, k in each), error, label))
    return [(i, c, e, sums[label]) for i, c, e, label in found], books


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, v, label, "x", -1) for i, v, label in rows], SCHEMA)
    got = vector_codes.compress(df.repartition(3), **how)
    want, books = plain(rows, **how)
    assert sorted((tuple(r) for r in got.codes.collect()), key=key) == sorted(want, key=key)
    assert [b.tolist() for b in got.codebooks] == books


def test_random_vectors(spark):
    rnd = np.random.default_rng(12)
    centres = rnd.normal(size=(9, 32))
    rows = [(int(k), (centres[k % 9] + rnd.normal(size=32) * 0.2).astype(np.float32).tolist(), int(k % 4) or None) for k in range(400)]
    check(spark, rows)


def test_ties_repeats_and_rows_that_go(spark):
    rnd = np.random.default_rng(3)
    rows = [(k % 150, (rnd.integers(-2, 3, 16) / 256).tolist(), k % 3) for k in range(300)]
    rows += [(None, [0.5] * 16, None)] * 3 + [(7, [0.0] * 16, 1)] * 40
    rows += [(1000, None, 1), (1001, [float("nan")] + [0.0] * 15, 1), (1002, [None] + [0.0] * 15, 1),
             (1003, [float("-inf")] + [0.0] * 15, 2)]
    check(spark, rows)
    check(spark, rows, entries=3, rounds=4)


def test_fewer_rows_than_entries_and_uneven_parts(spark):
    rnd = np.random.default_rng(4)
    check(spark, [(k, rnd.normal(size=21).tolist(), None) for k in range(20)])
    check(spark, [(5, [1.0] * 16, 2)])


def test_empty_tables_and_other_lengths(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = vector_codes.compress(empty)
    assert got.codes.collect() == [] and got.codebooks == []
    rows = [(k, [0.1 * k] * 16, 1, "x", 0) for k in range(5)] + [(9, [1.0] * 3, 1, "x", 0), (10, [], None, "x", 0)]
    got = {r["vec_id"]: r for r in vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).codes.collect()}
    assert len(got) == 7 and got[9]["code"] is None and got[10]["error"] is None and got[3]["error"] == 0


@pytest.mark.parametrize("spread", [0.5, 40, 5000])
def test_trees_cover_and_assign_as_brute_force(spread):
    rnd = np.random.default_rng(int(spread))
    points = np.round(rnd.normal(size=(3000, 4)) * spread).astype(np.int64)
    part = np.repeat(np.arange(3), 1000)
    trees = cover_trees(points.copy(), part)
    assert (np.sort(trees.order) == np.arange(3000)).all() and (points[trees.order] == trees.points).all()
    for node, total in zip(trees.nodes, trees.sums):
        own = trees.points[node["first"] : node["last"]]
        off = np.sqrt(((own - trees.points[node["centre"]]) ** 2).sum(axis=1))
        assert np.isclose(off.max(), node["radius"]) and (own.sum(axis=0) == total).all()
        kids = trees.nodes[node["child"] : node["child"] + node["children"]]
        if len(kids):
            reach = 2.0 ** (math.ceil(math.log2(node["radius"]) - 1e-9) - 1)
            assert kids["first"][0] == node["first"] and (kids["last"][-1], kids["last"][:-1].tolist()) == (node["last"], kids["first"][1:].tolist())
            assert (kids["radius"] <= reach).all() and kids["centre"][0] == node["centre"]
            centres = trees.points[kids["centre"]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
            assert (apart[~np.eye(len(kids), dtype=bool)] > reach).all()
    entries = [trees.points[rnd.integers(0, 3000, 20)] for _ in range(3)]
    code, number, total = assign(trees, Books(entries))
    for p in range(3):
        mine = part[trees.order] == p
        off = ((trees.points[mine][:, None] - entries[p][None]) ** 2).sum(axis=2)
        assert (off.argmin(axis=1) == code[mine]).all()
        assert (np.bincount(code[mine], minlength=20) == number[20 * p : 20 * p + 20]).all()
    assert (total.sum(axis=0) == points.sum(axis=0)).all()


def test_many_labels_are_salted(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 2)
    rnd = np.random.default_rng(6)
    check(spark, [(k, rnd.normal(size=16).tolist(), None if k % 5 == 0 else k % 7) for k in range(90)])
