import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import suffix_levels
from millrace.llm.suffix_levels import MATCH

SCHEMA = "doc_id long, text string, ka int, spans string, core int"


def plain_repeats(texts):
    """(n_bytes, n_removed, n_spans, sha256) per text, from all windows of all texts."""
    seen = {}
    texts = [(t or "").encode() for t in texts]
    for t in texts:
        for p in range(len(t) - MATCH + 1):
            w = t[p : p + MATCH]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - MATCH + 1):
            if seen[t[p : p + MATCH]] > 1:
                gone[p : p + MATCH] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeñ", k=rng.randint(1, 9))) for _ in range(n))


def check(spark, texts, ids=None, **how):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)
    rows = suffix_levels.digest(df, **how).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)
    assert got == sorted(((i, *p) for i, p in zip(ids, plain_repeats(texts), strict=True)), key=str)
    return got


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    passages = [prose(rng, n) for n in (90, 120, 300, 70)]
    out = []
    for _ in range(40):
        parts = [prose(rng, rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [p[cut : len(p) - rng.randint(0, 60)], prose(rng, rng.randint(0, 30))]
        out.append("".join(parts))
    near = list(prose(rng, 260))
    for _ in range(8):  # near copies: letters changed here and there
        copy = near.copy()
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = "Z"
        out.append("".join(copy))
    return out


def test_passages_and_near_copies(spark, texts):
    got = check(spark, texts)
    assert any(0 < r[2] < r[1] for r in got) and any(r[3] > 1 for r in got)


def test_dense_cores_are_cut_until_windows_stand_alone(spark, texts):
    check(spark, texts, dense=1, batches=3)


def test_one_passage_in_many_texts(spark):
    rng = random.Random(6)
    passage = prose(rng, 160)
    check(spark, [prose(rng, 20) + passage[rng.randint(0, 9) :] + prose(rng, 20) for _ in range(60)], dense=8)


def test_unusual_rows(spark):
    rng = random.Random(5)
    a, line = prose(rng, 150), prose(rng, 30)
    exact = "".join(rng.choices("xyz", k=MATCH))
    data = [a, a, None, "", "short", a + "!", "é" * 700, "ab" * 450, line * 9, exact + "1", "2" + exact, exact[1:] + "33", prose(rng, 99)]
    check(spark, [*data, data[0], data[-1]], [1, 1, 2, 3, None, 5, 6, 7, 8, 9, 10, 11, 12, 1, None])
    check(spark, [None, "", "x"])
    assert check(spark, []) == []


def test_long_texts_are_indexed_in_pieces(spark, texts, monkeypatch):
    # in this process, where the kernel can be reached
    whole = suffix_levels.runs_of("".join(texts).encode())
    monkeypatch.setattr(suffix_levels, "PIECE", 900)
    cut = suffix_levels.runs_of("".join(texts).encode())
    assert cut["windows"].sum() == whole["windows"].sum() == len("".join(texts).encode()) - MATCH + 1
    assert set(whole["start"]) <= set(cut["start"]) and set(whole["core"]) == set(cut["core"])


def test_equal_windows_have_equal_cores():
    rng = random.Random(8)
    shared = prose(rng, 200).encode()
    one, two = prose(rng, 100).encode() + shared, prose(rng, 55).encode() + shared + prose(rng, 50).encode()
    owners = []
    for text in (one, two):
        runs = suffix_levels.runs_of(text)
        core = np.repeat(runs["core"], runs["windows"])
        at = text.index(shared)
        owners.append(core[at : at + len(shared) - MATCH + 1])
    assert owners[0].tolist() == owners[1].tolist()


def test_levels_are_a_binary_counter(spark):
    index = suffix_levels.SuffixLevels(spark)
    news = []
    for n in range(7):
        # batch n holds core n, and core 100 in the first and the sixth
        cores = [n, *([100] if n in (0, 5) else []), *([50, 50] if n == 3 else [])]
        df = spark.createDataFrame([(c, c, 1) for c in cores], "head long, core long, copies int")
        news.append({r.core for r in index.add(df).collect()})
    assert sorted(index.levels) == [1, 2, 4]
    assert news[0] == news[1] == news[2] == set() and 50 in news[3] and 100 in news[5]
    assert {r.core for r in index.repeated().collect()} == {50, 100}
    level = index.levels[4][1].orderBy("core").collect()
    assert [(r.core, r.copies) for r in level] == [(0, 1), (1, 1), (2, 1), (3, 1), (50, 2), (100, 1)]


def test_arrays_sort_as_bytes_do():
    texts = [bytes([b]) + b"0123456" for b in (0, 1, 127, 128, 255)]
    heads = [suffix_levels.runs_of(t * 60)["head"] for t in texts]
    for t, found in zip(texts, heads, strict=True):
        assert {int(h) + (1 << 63) for h in found} <= {int.from_bytes((t * 60)[a : a + 8], "big") for a in range(8)}
