import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import anchor_lists

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, score int, cluster int"


def plain_mining(rows, count=5):
    """rows as (id, vector, label); all pairs."""
    rows = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows]
    out = []
    for n, (i, v, y) in enumerate(rows):
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for m, (j, w, z) in enumerate(rows) if m != n and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == y)[:count]:
            fit = sorted(x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s)[:count]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit)]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    vectors = anchor_lists.integer_vector(F.col("embedding"), 256)
    found = anchor_lists.mine(df, "vec_id", vectors, F.col("label"), F.col("vec_id") % 100 == 0, **how)
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture
def clustered():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(900):
        label = int(rng.integers(6))
        rows.append((i, (centres[(label + rng.integers(2)) % 6] + rng.normal(scale=0.2, size=8)).tolist(), label))
    return rows


def test_clustered_rows_in_many_blocks(spark, clustered):
    assert run(spark, clustered, chunk=60, block=3, slices=(0.05, 0.3, 1.0)) == plain_mining(clustered)


def test_ties_and_unusual_rows(spark):
    one, two = [1.0, 0.5], [0.9, 0.6]
    rows = [(100, one, 1), (3, one, 1), (2, one, 1), (2, one, 1), (7, one, 2), (6, one, 2), (5, two, 3), (5, two, 3), (200, [0.0, 0.0], 1)]
    rows += [(300, [-1.0, 0.0], 4), (301, [1.0, 0.0], 4), (400, None, 1), (401, [1.0, None], 1), (402, [float("nan"), 1.0], 2)]
    rows += [(403, [float("inf"), 1.0], 2), (404, one, None), (None, one, 2), (500, [1.0, 1.0, 1.0], 1), (501, [1.0, 1.0, 0.9], 1)]
    rows += [(502, [1.0, 0.9, 0.9], 2), (600, [], 1), (601, [], 1), (602, [], 2), (700, two, 9)]
    assert run(spark, rows) == plain_mining(rows)
    assert run(spark, []) == [] and run(spark, [(1, one, 1)]) == []


def test_large_components_stay_exact():
    members, rows = np.array([[1 << 40, 3], [5, -(1 << 40)]]), np.array([[1 << 20, 1], [7, 1 << 21]])
    assert anchor_lists.products(members, rows).tolist() == [[(1 << 60) + 3, (7 << 40) + (3 << 21)], [(5 << 20) - (1 << 40), 35 - (1 << 61)]]


def test_bounds_hold(clustered):
    vectors = np.floor(256 * np.array([v for _, v, _ in clustered]))
    members = vectors[::50]
    centres = anchor_lists.fit_centres(members, 4)
    nearest = anchor_lists.angles(members, centres).argmin(axis=1)
    walked = []
    for c in range(len(centres)):
        own = members[nearest == c]
        if len(own):
            spread = anchor_lists.angles(own, centres)[:, c].max()
            turn = anchor_lists.angles(vectors, centres)[:, c]
            length = anchor_lists.lengths(vectors)
            bound = length * np.cos(np.maximum(0, turn - spread)) + length * anchor_lists.SLACK
            limit = anchor_lists.lengths(own)[:, None] * bound[None, :]
            scores = own @ vectors.T
            assert (scores <= limit).all()
            walked.append((limit >= np.sort(scores, axis=1)[:, -5:-4]).mean())
    assert np.mean(walked) < 0.7  # lists end before their last rows


def test_best_keeps_the_first_of_equal_ones():
    scores = np.array([[5, 5, 5, 1], [0, 9, 9, 9]])
    line, column = anchor_lists.best(scores, np.array([[True, False, True, True], [True] * 4]), 2)
    assert line.tolist() == [0, 0, 1, 1] and column.tolist() == [0, 2, 1, 2]
