import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import hmm

SCHEMA = "doc_id long, text string, held_out string, words int"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def base_scores(docs, folds=10):
    held = {i: zlib.crc32(str(i).encode()) % folds == 0 for i in docs}
    c = Counter(t for i, text in docs.items() if not held[i] for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = {}
    for i, text in docs.items():
        ts = tokens(text)
        out[i] = (held[i], len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
    return out


@pytest.mark.parametrize("block", [1_500_000, 5_000])
def test_sample_table(spark, block, monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", block)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = {r.doc_id: r.text for r in df.collect()}
    rows = {r.doc_id: r for r in hmm.score(df, rounds=2).collect()}
    for i, (held, n, known, total, base) in base_scores(docs).items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def likelihood(model, emit):
    """Sum over all paths of states."""
    k, total = len(model.start), 0.0
    for path in itertools.product(range(k), repeat=len(emit)):
        p = model.start[path[0]] * emit[0, path[0]]
        for t in range(1, len(emit)):
            p *= model.move[path[t - 1], path[t]] * emit[t, path[t]]
        total += p
    return total


def random_model(rng, k, classes):
    m = hmm.Model(rng.random(k), rng.random((k, k)), rng.random((classes, k)))
    return hmm.Model(m.start / m.start.sum(), m.move / m.move.sum(axis=1, keepdims=True), m.emit / m.emit.sum(axis=0))


def test_recursions_equal_sums_over_all_paths():
    rng = np.random.default_rng(3)
    model, lengths = random_model(rng, 3, 5), np.array([5, 3, 3, 1])
    cls = rng.integers(0, 5, lengths.sum())
    starts = np.cumsum(lengths) - lengths
    log = hmm.log_likelihood(model, cls, starts, lengths)
    first, moves, places, gammas, total_log = hmm.expected(model, cls, starts, lengths)
    assert total_log == pytest.approx(log.sum())
    # expected counts by hand: paths weighted by their probability
    want_first, want_moves, want = np.zeros(3), np.zeros((3, 3)), np.zeros((lengths.sum(), 3))
    for i, (a, n) in enumerate(zip(starts, lengths, strict=True)):
        e = model.emit[cls[a : a + n]]
        total = likelihood(model, e)
        assert 10 ** log[i] == pytest.approx(total)
        for path in itertools.product(range(3), repeat=n):
            p = model.start[path[0]] * e[0, path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * e[t, path[t]]
            want_first[path[0]] += p / total
            for t in range(n):
                want[a + t, path[t]] += p / total
                if t:
                    want_moves[path[t - 1], path[t]] += p / total
    got = np.zeros_like(want)
    got[places] = gammas
    assert np.allclose(first, want_first) and np.allclose(moves, want_moves) and np.allclose(got, want)


def test_codes_survive_squeezing():
    codes = np.random.default_rng(0).integers(0, 1 << 24, 5000)
    assert hmm.unsqueezed(hmm.squeezed(codes)).tolist() == codes.tolist()
    assert hmm.unsqueezed(hmm.squeezed(codes[:0])).tolist() == []


def test_batches_hold_every_text_once():
    lengths = np.array([3, 9, 1, 9, 4, 2])
    batches = list(hmm.batches_of(lengths, 10))
    assert sorted(np.concatenate(batches)) == list(range(6))
    assert all((np.diff(lengths[b]) <= 0).all() for b in batches)


def test_rounds_raise_the_likelihood_and_emissions_add_up(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stats = hmm.corpus(df)
    model, values = hmm.first_states(stats, 4), []
    for _ in range(4):
        model, value = hmm.baum_welch_round(stats, model)
        values.append(value)
    assert values[1:] == sorted(values[1:]) and values[-1] > values[0]
    # known words (c - d of their class's tokens) and the unknown word share probability one
    known = 1 - stats.discount * stats.class_words / np.maximum(stats.class_tokens, 1)
    assert np.allclose(known @ model.emit[:-1] + model.emit[-1], 1)


def test_unusual_rows(spark):
    data = [(1, None, "", 0), (2, "", "", 0), (3, "a B\tc", "", 0), (3, "a B\tc", "", 0), (None, "zz zz", "", 0), (4, "w " * 9000, "", 0)]
    rows = hmm.score(spark.createDataFrame(data, SCHEMA), rounds=1).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 3), (1, 1), (2, 1), (3, 4), (3, 4), (4, 9001)]
    assert all(math.isfinite(r.score) for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}


def test_nothing_to_learn_from(spark):
    assert hmm.score(spark.createDataFrame([], SCHEMA)).collect() == []
    row = hmm.score(spark.createDataFrame([(None, "a b", "", 0)], SCHEMA)).first()
    assert (row.train_tokens, row.n_known, row.base_score, row.score) == (0, 0, 0.0, 0.0)
