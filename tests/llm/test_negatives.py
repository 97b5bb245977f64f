"""Hard negatives against scoring all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditledger.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows: list[tuple]) -> dict[int, tuple]:
    known = {}
    for id_, vector, label in rows:
        if id_ is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        own = (label, [float(np.float32(x)) for x in vector])
        known[id_] = min(known.get(id_, own), own)
    return {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in known.items()}


def expected(rows: list[tuple], every: int) -> list[tuple]:
    known, found = usable(rows), []
    for anchor, (label, vector) in known.items():
        if anchor % every:
            continue
        seen = sorted(
            (-sum(a * b for a, b in zip(vector, v, strict=False)), i, other)
            for i, (other, v) in known.items()
            if i != anchor
        )
        for score, positive, _ in [s for s in seen if s[2] == label][:5]:
            fits = [
                s for s in seen
                if s[2] != label and 30 * -score <= 100 * -s[0] and 100 * -s[0] <= 90 * -score
            ]
            for rank, (own, other, _) in enumerate(fits[:10], 1):
                found.append((anchor, positive, rank, other, -score, -own))
    return sorted(found)


def mined(docs, every: int) -> list[tuple]:
    rows = negatives.mined(docs, "vec_id", "label", "embedding", F.col("id") % every == 0)
    return sorted(tuple(r) for r in rows.collect())


@pytest.fixture(params=[(256, 1024), (4, 16)], ids=["one leaf", "many tiles"])
def small(request, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_ROWS", request.param[0])
    monkeypatch.setattr(negatives, "LEAST_TILE", request.param[1])


def clustered(seed: int, n: int, dims: int = 8) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    which = rng.integers(0, 12, n)
    vectors = centres[which] + rng.normal(scale=0.3, size=(n, dims))
    return [
        (int(i), [float(x) for x in v], int(rng.integers(0, 4)))
        for i, v in zip(rng.permutation(5 * n)[:n], vectors, strict=True)
    ]


def test_same_as_scoring_all_rows(spark, small):
    rows = clustered(1, 900)
    want = expected(rows, 20)
    assert len(want) > 500
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(6), 20) == want


def test_a_third_of_all_rows_has_one_vector(spark, small):
    rows = clustered(2, 300)
    rows += [(10_000 + i, rows[0][1], i % 2) for i in range(150)]
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(6), 50) == expected(rows, 50)


def test_equal_scores_are_ordered_by_id(spark, small):
    """Vectors along the axes: nearly all scores are equal."""
    rows = [(i, [1.0 if k == i % 40 else 0.5 for k in range(40)], i % 3) for i in range(400)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 40) == expected(rows, 40)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.5, 0.25], 2), (3, [0.25, 0.5], 2),
        (4, None, 1), (5, [1.0, None], 1), (6, [inf, 1.0], 2), (7, [nan, 1.0], 2), (8, [1.0, 1.0], None),
        (None, [1.0, 0.5], 1), (9, [], 2), (10, [0.75], 1), (11, [0.75, 0.0, 3.0], 2),
        (2, [0.5, 0.25], 2), (3, [0.25, 0.5], 3), (12, [-1.0, -1.0], 1), (-20, [0.5, 0.5], 1),
        (13, [1000.0, 2000.0], 2), (40, [0.0, 0.0], 5), (41, [0.0, 0.0], 5),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows, 20)
    assert want
    names = ("id", "leaf", "tile", "stored", "windows", "vector", "rank", "score")
    more = docs.withColumns({c: F.lit(1) for c in names})
    assert mined(docs, 20) == mined(more, 20) == want
    assert mined(docs.filter("1 = 0"), 20) == []
    assert mined(docs.filter("vec_id = 0"), 20) == []
    assert mined(docs.filter("label = 1"), 20) == []


def test_long_vectors_are_scored_exactly(spark):
    """Scores beyond 2^53, where doubles skip whole numbers."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(200_000, 400_000, 6)], i % 2) for i in range(60)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == expected(rows, 10)


def tree_of(rows: np.ndarray, levels: int) -> tuple[negatives.Tree, np.ndarray]:
    tree = negatives.Tree(rows[:400], levels, float((rows * rows).sum(axis=1).max()))

    def see(number, away, nearest):
        node = tree.nodes[number]
        for j in np.unique(nearest):
            node.low[:, j] = away[nearest == j].min(axis=0)
            node.high[:, j] = away[nearest == j].max(axis=0)

    return tree, tree.place(rows, see)


def test_no_leaf_that_holds_a_match_is_left_out():
    rng = np.random.default_rng(4)
    for dims in (2, 6):
        rows = np.floor(256 * (rng.normal(size=(3000, dims)) * 0.2 + rng.normal(size=(20, dims))[rng.integers(0, 20, 3000)]))
        tree, leaf = tree_of(rows, 2)
        assert tree.leaves > 30
        asking = np.concatenate([rows[:100], np.floor(256 * rng.normal(size=(100, dims)))])
        seen = asking @ rows.T
        lo = np.quantile(seen, rng.random(), axis=1)
        hi = lo + np.abs(lo) * rng.random()
        alive = tree.alive(asking, lo, hi)
        fits = (seen >= lo[:, None]) & (seen <= hi[:, None])
        at, row = np.nonzero(fits)
        assert alive[at, leaf[row]].all()


def test_most_leaves_are_left_out_where_rows_are_clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    rows = np.floor(256 * (centres[rng.integers(0, 40, 4000)] + rng.normal(scale=0.03, size=(4000, 16))))
    tree, leaf = tree_of(rows, 2)
    own = rows[:200]
    best = np.partition(own @ rows.T, -10, axis=1)[:, -10]
    alive = tree.alive(own, best, np.full(200, 2.0**60))
    asked = alive @ np.bincount(leaf, minlength=tree.leaves)
    assert asked.mean() < 0.4 * len(rows)


def test_firsts_settles_ties_by_place():
    own = np.array([[5, 5, 5, 5, 9], [1, 2, 3, 4, 5]])
    allowed = np.array([[True, False, True, True, True], [False] * 5])
    assert negatives.firsts(own, allowed, 2).tolist() == [[True, False, False, False, True], [False] * 5]
