"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from logquarry.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, block int, a int"


def plainly(rows):
    usable = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.add((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for vec_id, label, v in usable:
        if vec_id % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, own) for i, own, w in usable if len(w) == len(v)]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == label and s[1] != vec_id][:5]:
            inside = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(vec_id, positive, rank, i, -p, -n) for rank, (n, i, _) in enumerate(inside, 1)]
    return sorted(out)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(parts)
    result = negatives.mined(df)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in result.collect())


def some(n, dims=8, seed=1):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + draw.gauss(0, 0.5) for c in centres[i % 6]], draw.randrange(4)) for i in range(n)]


def test_against_brute_force(spark):
    rows = some(1500)
    assert run(spark, rows) == plainly(rows)


@pytest.mark.parametrize("step, members, block", [(16, 3, 40), (64, 1024, 1 << 16)])
def test_blocks_and_walks(monkeypatch, spark, step, members, block):
    rows = some(900, dims=3, seed=2)
    usable = negatives.usable(spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "id long, v array<float>, label int"), "id", "v", "label")
    usable = negatives.stored(usable)
    got = negatives.hard_negatives(usable, usable.where("id % 100 = 0"), block=block).collect()
    moved = [(i, v, label if i % 7 else (label - 1) % 10) for i, v, label in rows]  # undoes the rule of the brute force
    assert sorted(tuple(r) for r in got) == plainly(moved)


def test_ties_hot_vectors_and_odd_rows(spark):
    hot = [(i, [1.0, 2.0], 1) for i in range(0, 900)] + [(i, [1.0, 1.0], 2) for i in range(900, 1000)]
    odd = [
        (None, [1.0, 1.0], 1), (1001, None, 1), (1002, [1.0, 1.0], None), (1003, [float("nan"), 1.0], 2), (1004, [float("inf"), 1.0], 2),
        (1005, [None, 1.0], 2), (1100, [0.0, 0.0], 1), (1200, [-1.0, -2.0], 1), (1300, [1.0, 1.0, 1.0], 1), (1301, [1.0, 1.0, 1.0], 1),
        (1302, [1.0, 0.4, 1.0], 2), (1400, [], 3), (1401, [], 3), (1403, [], 4), (1500, [1.0, 2.0], 2), (-100, [2.0, 1.0], 1), (100, [1.0, 2.0], 1),
        (100, [5.0, 2.0], 3), (1601, [100000.0, 3.0], 5),
    ]
    rows = hot + odd
    got = run(spark, rows)
    assert got == plainly(rows)
    assert any(r[0] == 1300 for r in got) and any(r[0] == 1400 for r in got)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_walk_stops_early():
    """Members of one direction look at few of the candidates, and miss none."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(20, 16)) * 300
    vectors = np.floor(centres[np.arange(20_000) % 20] + draw.normal(size=(20_000, 16)) * 20).astype(np.int32)
    n = len(vectors)
    entries = negatives.Entries(vectors, np.zeros(n, np.int64), np.arange(n), np.arange(n + 1), np.linalg.norm(vectors.astype(float), axis=1))
    own = np.arange(0, 2000, 20)
    members = negatives.Members(own, own, np.zeros(100, np.int64), vectors[own], np.zeros((100, 0), np.int64), np.zeros((100, 0), bool))
    best, scored = negatives.walk(members, entries, 30, 90, 5, step=256)
    assert scored < 0.3 * 100 * n
    scores = vectors[own].astype(np.int64) @ vectors.astype(np.int64).T
    for i in range(100):
        order = [j for j in np.lexsort((np.arange(n), -scores[i])) if j != own[i]][:5]
        assert best.ids[best.keys == i].tolist() == order


def test_large_products():
    one = np.array([[2**30, -(2**30)]], np.int32)
    assert negatives._products(one, one).tolist() == [[2**61]]
    assert negatives._products(np.array([[3, 4]], np.int32), np.array([[2**29, 1]], np.int32)).tolist() == [[3 * 2**29 + 4]]
