import numpy as np
import pytest

from millrace.llm import toxicity

DOCS = "doc_id long, text string, toxic int, score string"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(rows) == docs.count()
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].held_out]
    hits = sum(p and y for p, y in held)
    assert hits / sum(y for _, y in held) > 0.9
    assert hits / sum(p for p, _ in held) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


@pytest.fixture(scope="module")
def small(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300)]
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(400):
        text = " ".join(rng.choice(words, 30))
        bad = i % 5 == 0
        docs.append((i, f"{text} you grimblot {text}" if bad else text, 0, ""))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_mined_terms_and_unusual_rows(spark, small):
    docs, labels = small
    odd = [(None, "x", 0, ""), (900, None, 0, ""), (901, "", 0, ""), (902, "GRIMBLOT " * 5000, 0, ""), (902, "GRIMBLOT " * 5000, 0, "")]
    df, tags = spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (5, 1, 1)], LABELS)
    rows = toxicity.score(df, tags).collect()
    assert len(rows) == len(docs) + len(odd)
    got = {r.doc_id: r.predicted for r in rows}
    assert all(got[i] == (i % 5 == 0) for i in range(400))
    assert (got[None], got[900], got[901], got[902]) == (0, 0, 0, 1)
    kept = toxicity.drop_toxic(df, tags)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([*(i for i in range(400) if i % 5), -1, 900, 901])


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "you are a worthless idiot and a moron", 0, ""), (2, "a fine day", 0, "")], DOCS)
    rows = toxicity.score(df, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 2 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_terms_are_counted_at_word_beginnings():
    terms = [toxicity.Term("bad", 1), toxicity.Term("bad", 1, True), toxicity.Term("badly", 2), toxicity.Term("été", 1)]
    counter = toxicity.TermCounter(terms)
    counts = counter.count("Bad badly, notbad BADLY badé été")[counter.column]
    assert counts.tolist() == [4, 1, 2, 1]


def test_label_model_discounts_repeated_voters(spark):
    """Three copies of one voter weigh together about as much as a voter of their own."""
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    own = [np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.02) for _ in range(4)]
    bits = np.stack([own[0], own[0], own[0], *own[1:], ~np.any(own, axis=0)], axis=1)
    grouped = spark.createDataFrame([(m, -1, 1) for m in toxicity.packed(bits)], "mask binary, gold int, n long")
    model = toxicity.fit_label_model(grouped, bits.shape[1], 0.2)
    assert model.weight[:3].sum() == pytest.approx(1, abs=0.4)
    assert ((model.posterior(bits, np.full(4000, -1)) > 0.5) == y).mean() > 0.9


def test_every_term_votes_and_every_hit_counts(spark):
    """Eighty insults, each in a few documents of its own: none is crowded out by the others or by the fixed list."""
    names = [f"{a}{b}{c}lum" for a in "bdfgk" for b in "aeio" for c in "rstz"]
    rng = np.random.default_rng(3)
    words = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    docs, labels = [], []
    for i in range(4000):
        bad = i % 4 == 0
        docs.append((i, " ".join([*rng.choice(words, 12), names[i // 4 % 80] if bad else "end"]), 0, ""))
        labels.append((i, 1, int(bad)))
    docs += [(5000 + i, f"some {n} text", 0, "") for i, n in enumerate([*names, *toxicity.FIXED_TERMS])] + [(6000, "some plain text", 0, "")]
    df, tags = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    scorer, _ = toxicity.fit(df, tags)
    texts = {t.text for t in scorer.terms}
    assert len(scorer.terms) > 62 and texts >= set(toxicity.FIXED_TERMS) and all(any(n.startswith(t) for t in texts) for n in names)
    got = {r.doc_id: r.predicted for r in toxicity.score(df, tags).collect()}
    assert all(got[5000 + i] for i in range(80)) and not got[6000]
    assert toxicity.TermCounter([toxicity.Term("scum", 1)]).count("scum " * 70_000).tolist() == [70_000]


def test_terms_that_say_the_same_are_one(spark):
    """Beginnings of a word, and a wider one that adds only clean documents, leave one term; a second word has its own."""
    texts = [("you loser now", 1)] * 20 + [("they lose now", 0)] * 30 + [("a moron here", 1)] * 10 + [("you calm now", 0)] * 70 + [("a day here", 0)] * 70
    sample = spark.createDataFrame([(f"{t} {i}", y) for i, (t, y) in enumerate(texts)] + [(None, 0)], "text string, toxic int")
    assert [(t.text, t.whole, t.level) for t in toxicity.mine_terms(sample)] == [("loser", False, 1), ("moron", False, 1)]


def test_equal_votes_pack_and_unpack():
    import pandas as pd

    bits = np.random.default_rng(0).random((50, 133)) < 0.3
    assert (toxicity.unpack(pd.Series(toxicity.packed(bits)), 133) == bits).all()
    assert toxicity.unpack(pd.Series([], dtype=object), 9).shape == (0, 9)
