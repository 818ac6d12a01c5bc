import math
import random
import re

import numpy as np
import pyarrow as pa

from millrace.llm import mask_ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item_id long, rank string, score int"
ITEMS = "item_id long, text string, doc_id long, n int"


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_ranking(docs, items, top):
    """docs and items as (id, text); brute force over all pairs."""
    cut = [(i, terms_of(t)) for i, t in docs]
    cut = [(i, t) for i, t in cut if t]
    total, length = len(cut), sum(len(t) for _, t in cut)
    df = {}
    for _, t in cut:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        found = []
        for doc, t in cut:
            m, score = 100 - 50 + (50 * len(t) * total) // length, 0
            for term in set(terms_of(text)) & set(t):
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * t.count(term)) // (1000 * t.count(term) + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **how):
    docs_df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOCS).repartition(3)
    items_df = spark.createDataFrame([(*i, 5, 6) for i in items], ITEMS)
    rows = mask_ranking.rank(docs_df, items_df, **how).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def test_terms():
    text = "Ab-cD 9xİé\x00b" + " word" * 3 + "_tail{"
    total, counts = mask_ranking.count_terms(text.encode())
    assert total == len(terms_of(text))
    assert {k.decode(): v for k, v in counts.items()} == {t: terms_of(text).count(t) for t in terms_of(text)}
    assert mask_ranking.count_terms(None) == (0, {})


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(mask_ranking, "PIECE", 7)
    text = " ".join(["alpha", "be", "gammadelta" * 3, "x"] * 9) + "  "
    total, counts = mask_ranking.count_terms(text.encode())
    assert total == 36 and counts[b"alpha"] == 9 and counts[b"gammadelta" * 3] == 9


def test_random_tables(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, 41), k=rng.randint(0, 30)))) for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 90)))) for i in range(12)]
    expected = plain_ranking(docs, items, 7)
    assert run(spark, docs, items, top=7) == expected
    # items dealt out over many blocks
    assert run(spark, docs, items, top=7, block_terms=30) == expected


def test_ties_repeats_and_unusual_rows(spark):
    docs = [(5, "a b"), (3, "a b"), (3, "a b"), (None, "A, b"), (9, None), (8, ""), (7, "--"), (1, "c " * 5000), (2, "É é"), (4, "zz")]
    items = [(1, "a b nothing"), (1, "a b nothing"), (2, None), (3, ""), (4, "unheard"), (None, "É"), (6, "c")]
    for top in (2, 50):
        assert run(spark, docs, items, top=top) == plain_ranking(docs, items, top)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_masks_below_the_ranking_are_not_scored():
    rng = np.random.default_rng(2)
    counts = rng.integers(1, 4, (2000, 10)) * (rng.random((2000, 10)) < np.linspace(0.9, 0.05, 10))
    terms = [np.flatnonzero(row) for row in counts]
    batch = pa.record_batch(
        [
            pa.array(range(2000), pa.int64()),
            pa.array(np.full(2000, 20), pa.int64()),
            pa.array(terms, pa.list_(pa.int32())),
            pa.array([row[t] for row, t in zip(counts, terms, strict=True)], pa.list_(pa.int64())),
        ],
        ["doc_id", "n", "terms", "counts"],
    )
    weights = np.linspace(100, 3000, 10).astype(np.int64)
    block = mask_ranking.Block(batch, weights, 2000, 40000)
    ranking = mask_ranking.Ranking(5)
    scored = ranking.search(block, np.arange(10, dtype=np.int32))
    everything = block.scores(np.arange(10), np.arange(2000))
    order = np.lexsort((np.arange(2000), -everything))[:5]
    assert ranking.ids.tolist() == order.tolist() and ranking.scores.tolist() == everything[order].tolist()
    assert scored < 400
    # masks of more than 64 terms
    wide = np.arange(200, dtype=np.int32)
    assert block.places(wide).tolist() == list(range(10))


def test_items_of_many_terms(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(150)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(120)]
    items = [(1, " ".join(words))]
    assert run(spark, docs, items, top=9) == plain_ranking(docs, items, 9)
