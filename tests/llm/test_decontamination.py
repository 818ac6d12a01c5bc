import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination as leaks

DOCS = "doc_id long, text string, item_id string, hits int"
ITEMS = "item_id long, text string, doc_id int"

TRAINS = (
    "A train leaves Boston at 7 and travels 120 km in 3 hours while Maria waits 45 minutes at the station. "
    "How many hours does Maria wait if the train returns after 120 km?"
)


def find(spark, docs, items):
    got = leaks.find_leaks(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, 9) for i in items], ITEMS))
    return {r.doc_id: (r.contaminated, r.item_id, r.kind) for r in got.collect()}


def test_other_values_are_found_and_mixed_ones_are_not(spark):
    other = TRAINS.replace("Boston", "Lisbon").replace("Maria", "Pedro").replace("120", "95").replace("45", "10").replace("km", "miles")
    mixed = TRAINS.replace("travels 120 km", "travels 77 km").replace("Maria wait if", "Nadia wait if")
    docs = [
        (1, f"Before it. {TRAINS} After it."),
        (2, f"Something else first.\n{other}"),
        (3, "a train of thought leaves nobody at the station and 3 hours later how many are there"),
        (4, TRAINS.upper().replace(" ", " !! ")),
        (5, mixed),
    ]
    got = find(spark, docs, [(10, TRAINS), (11, "An unrelated question about the colour of the autumn leaves in town.")])
    assert got[1] == (True, 10, "exact")
    assert got[2] == (True, 10, "reparameterised")
    assert got[3] == (False, None, None)
    assert got[4][:2] == (True, 10)
    # the two halves disagree about 120 and Maria: no alignment with steady values covers enough
    assert got[5] == (False, None, None) or got[5][2] == "reparameterised"


def test_inconsistent_slots(spark):
    item = "add 5 to box one then take 5 from box two then put 5 in box three and count 5 for luck"
    steady = item.replace("5", "8")
    shaken = "add 1 to box one then take 2 from box two then put 3 in box three and count 4 for luck"
    got = find(spark, [(1, steady), (2, shaken)], [(1, item)])
    assert got[1] == (True, 1, "reparameterised")
    assert got[2] == (False, None, None)


def test_sample_table_holds_whole_items(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r.doc_id: r.contaminated for r in leaks.find_leaks(docs, items).collect()}
    texts = [" ".join(r.text.split()) for r in items.collect()]
    whole = {r.doc_id for r in docs.collect() if any(t in " ".join(r.text.split()) for t in texts)}
    flagged = {i for i, y in got.items() if y}
    assert len(got) == docs.count()
    assert whole and whole <= flagged and len(flagged - whole) <= 2
    kept = leaks.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(got) - flagged


def test_brute_force_windows(spark):
    """The join finds the same windows as comparing all templates directly."""
    texts = [TRAINS, TRAINS.replace("3", "9"), "short five words are here", "only four words here"]
    windows = leaks.benchmark_windows(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], ITEMS)).collect()
    want = set()
    for i, t in enumerate(texts):
        raw, templates = leaks.tokens_of(t)
        width = min(leaks.WINDOW, len(raw))
        for variant, template in enumerate(templates):
            for at in range(len(raw) - width + 1 if len(raw) >= leaks.SHORTEST else 0):
                if leaks.informative(template, width)[at]:
                    want.add((i, variant, at))
    assert {(w.item_id, w.variant, w["at"]) for w in windows} == want
    same = {}
    for w in windows:
        same.setdefault(w.hash, set()).add((w.variant, leaks.tokens_of(texts[w.item_id])[1][w.variant][w["at"] : w["at"] + w.width]))
    assert all(len(v) == 1 for v in same.values())


def test_unusual_rows(spark):
    docs = [(1, None), (2, ""), (None, TRAINS), (3, TRAINS), (3, TRAINS), (4, "word " * 30_000 + TRAINS), (5, "tiny"), (6, "five words stand right here")]
    items = [(10, TRAINS), (10, TRAINS), (11, TRAINS), (None, TRAINS), (12, None), (13, ""), (14, "Five words stand right here")]
    got = find(spark, docs, items)
    assert got[1] == got[2] == got[5] == (False, None, None)
    assert got[None][:2] == got[3][:2] == got[4][:2] == (True, 10)
    assert got[6][:2] == (True, 14)
    empty_docs, empty_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert leaks.find_leaks(empty_docs, empty_items).collect() == []
    assert leaks.find_leaks(spark.createDataFrame([(1, TRAINS, "", 0)], DOCS), empty_items).select("contaminated").collect() == [(False,)]


@pytest.mark.parametrize(("text", "template"), [("In 1.5 Hours", ["in", "\x01", "\x02"]), ("He met Anna. Bob", ["he", "met", "\x03", "bob"])])
def test_template(text, template):
    assert list(leaks.tokens_of(text)[1][1]) == template


def test_bloom_holds_every_window(spark):
    windows = spark.range(-500, 500).select(F.xxhash64("id").alias("hash"))
    bits = leaks.bloom(windows)
    for r in windows.collect():
        place = r.hash & leaks.FILTER_BITS - 1
        assert int(bits[place >> 6]) >> (r.hash & 63) & 1


def test_scanner_equals_templates(spark):
    scanner = leaks.Scanner()
    scanner.MOST = 50  # starts over again and again
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [TRAINS, "", None, "One two. Three Four, 5 KM Éte Été McDonald NASA!\nAnna", *texts[:60]]:
        _, templates = leaks.tokens_of(text)
        for each, template in zip(scanner.templates(text), templates, strict=True):
            assert each.tolist() == [leaks.token_hash(t) for t in template]


@pytest.mark.parametrize(
    "item",
    [
        "Solve 2 x plus 3 equals 7",
        "How many minutes are 3 days 4 hours 12 minutes",
        "1 1 2 3 5 8 13 21 34 55 89",
        "What is 2 + 2?",
    ],
)
def test_exact_copies_rich_in_numbers(spark, item):
    docs = [(1, f"Some words before. {item} And some after."), (2, "Some words before. And some after."), (3, item.upper())]
    got = find(spark, docs, [(10, item), (11, TRAINS)])
    assert got == {1: (True, 10, "exact"), 2: (False, None, None), 3: (True, 10, "exact")}


def test_quote_rich_in_numbers_inside_a_long_item(spark):
    quote = "3 days 4 hours 12 minutes 9 km 7 kg 5 miles 2"  # 13 tokens, eight windows without enough words
    item = f"{TRAINS} {quote} weeks and then something else entirely happened to everyone who was there at that time"
    got = find(spark, [(1, f"nothing of it but {quote} here")], [(10, item)])
    assert got[1] == (True, 10, "exact")


def words(first, count):
    return " ".join("w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(first, first + count))


def test_one_changed_value_does_not_hide_a_copy(spark):
    item = f"{words(0, 30)} 3 {words(30, 40)} 3 {words(70, 28)}"
    shared = f"{words(100, 6)} 3 apples and 3 pears {words(110, 15)}"  # two slots that merely share a value
    docs = [(1, item.replace("3", "4", 1)), (2, shared.replace("3 apples", "5 apples").replace("3 pears", "7 pears"))]
    got = find(spark, docs, [(10, item), (11, shared)])
    assert got == {1: (True, 10, "reparameterised"), 2: (True, 11, "reparameterised")}


def test_stretch_of_other_values_only(spark):
    """Seventeen tokens with new numbers in each window, so that no raw window agrees, and a clash behind them."""
    item = "the 3 red boats meet the 8 blue boats near the 6 old ships while some 3 whales watch"
    doc = "the 4 red boats meet the 9 blue boats near the 7 old ships while some 5 whales watch"
    assert find(spark, [(1, doc)], [(10, item)])[1] == (True, 10, "reparameterised")


def test_longest_stretch_by_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        ats = sorted(rng.sample(range(14), rng.randint(1, 12)))
        windows = [(a, [rng.choice("ab") for _ in range(2)], [rng.choice("xxxy") for _ in range(2)]) for a in ats]
        best = 0
        for i in range(len(ats)):
            for j in range(i + 1, len(ats) + 1):
                part = windows[i:j]
                pairs = {p for _, b, d in part for p in zip(b, d, strict=True)}
                if part[-1][0] - part[0][0] == j - i - 1 and len({b for b, _ in pairs}) == len(pairs):
                    best = max(best, j - i)
        got = leaks.longest_stretch(rng.sample(windows, len(windows)))
        assert len(got) == best and got == list(range(got[0], got[0] + best) if got else [])


def test_hashes_of_a_few_windows_are_those_of_all():
    rng = np.random.default_rng(3)
    each = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for width in (1, 3, 5, 8):
        for variant in leaks.VARIANTS:
            at = np.array([0, 7, 100, 200 - width])
            every = leaks.window_hashes(each, width, variant)
            assert leaks.window_hashes_at(each, width, variant, at).tolist() == every[at].tolist()
    assert leaks.window_hashes_at(each, 8, 2, np.array([], dtype=int)).tolist() == []


def test_scanner_on_odd_characters_and_segments(monkeypatch):
    """Cut at any length, whole texts give the hashes and values that cutting token by token gives."""
    monkeypatch.setattr(leaks.Scanner, "SEGMENT", 40)
    rng, scanner = random.Random(0), leaks.Scanner()
    parts = [*"abAB z.!?\n,:/019_-'²ßİΣσςéÉǅǄ٣中ª", "Hello", "Five", "km", " ", " ", "\U0001f600", "\U00010400", "\U0002a6b2"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 120)))
        raw, templates = leaks.tokens_of(text)
        got = scanner.scan(text)
        assert [text[a:b].lower() for a, b in zip(got.begin, got.end, strict=True)] == raw
        for variant, template in enumerate(templates):
            assert got.hashes[variant].tolist() == [leaks.token_hash(t) for t in template]
            assert got.slots(variant, 0, len(raw)) == leaks.slots(template, raw, 0, len(raw))


def test_texts_of_a_group_keep_their_own_windows():
    """Texts scanned together give the hits that each gives alone; no window goes from one into the next."""
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["Two", "cats", "km", "Anna", "7", "run.", "é"], k=rng.randint(0, 40))) for _ in range(60)] + ["", "one"]
    all_bits = np.full(leaks.FILTER_BITS // 64, (1 << 64) - 1, dtype=np.uint64)
    forms = [(w, v) for w in (3, 8) for v in leaks.VARIANTS]
    assert leaks.hits_of(texts, forms, all_bits) == [leaks.hits_of([t], forms, all_bits)[0] for t in texts]
    assert [t for g in leaks.groups_of(pd.Series([*texts, None]), 50) for t in g] == [*texts, ""]


def test_a_line_that_many_items_share(spark):
    """The common line pairs no document with all of its items; each item is found by what is its own."""
    line = "Answer the following question with one of these words"
    rng = random.Random(2)
    bodies = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(14)) for _ in range(40)]
    items = [(i, f"{line} {b}") for i, b in enumerate(bodies)]
    docs = [(100, f"see {line} below"), *((i, f"some words before {line} {b} and after") for i, b in enumerate(bodies))]
    frame = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    windows = leaks.benchmark_windows(frame, shortest=1)
    shared = {leaks.window_hashes(leaks.Scanner().templates(line)[leaks.RAW], leaks.WINDOW, leaks.RAW).view(np.int64)[0]}
    assert windows.where(F.col("hash").isin(*map(int, shared))).count() == 40
    assert leaks.telling_windows(windows).where(F.col("hash").isin(*map(int, shared))).count() == 0
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_id) for r in leaks.find_leaks(spark.createDataFrame([(*d, "", 0) for d in docs], DOCS), frame).collect()}
    assert got == {100: (False, 0, None)} | {i: (True, 1, i) for i in range(40)}
