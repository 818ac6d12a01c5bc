import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import nndescent

SCHEMA = "vec_id long, embedding array<float>, id string, home int"


def exact(rows, k):
    """Brute force in double precision; ties to the smaller id."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for i in range(len(ids)):
        if ids[i] % 20 == 0:
            s = x @ x[i]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def ask(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)
    return by_query(nndescent.neighbours(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, settings=nndescent.Settings(**settings)))


def test_recall_of_graph_and_search(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "LEAF", 200)
    monkeypatch.setattr(nndescent, "BLOCK", 300)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2500, 32))
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(x)]
    got, want = ask(spark, rows), exact(rows, 20)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact_scores = {(q, i): s for q in want for i, s in zip(range(2500), (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(float) @ np.array(rows[q][1], dtype=np.float32).astype(float), strict=True)}
    assert all(s == pytest.approx(exact_scores[q, i], abs=1e-12) for q in got for i, s in got[q])


def test_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(i, rows[3][1]) for i in range(100, 180)] + [(180, [-c for c in rows[3][1]])]
    odd = [(200, None), (220, [0.0] * 6), (240, [1.0, None, *[0.0] * 4]), (260, [float("nan")] * 6), (280, [float("inf"), *[0.0] * 5])]
    odd += [(300, []), (320, [1.0, 2.0]), (None, rows[0][1])]
    got, want = ask(spark, rows + rows[:25] + odd), exact(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [0.0, 1.0])]
    assert {q: [i for i, _ in r] for q, r in ask(spark, rows).items()} == {0: [20, 7], 20: [0, 7]}
    assert ask(spark, [(0, [1.0])]) == {}
    assert ask(spark, []) == {}


def test_nearest():
    u, w, s = nndescent.nearest(np.array([1, 1, 0, 1, 1]), np.array([5, 5, 9, 4, 3]), np.array([2.0, 2.0, 1.0, 2.0, 1.0]), 2)
    assert (u.tolist(), w.tolist(), s.tolist()) == ([0, 1, 1], [9, 4, 5], [1.0, 2.0, 2.0])
