import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.common import connected_components

SCHEMA = "doc_id long, text string, component_id string, fp int"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Brute force: links between all pairs at three or fewer differing bits."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def check(rows):
    ids, prints = [r.doc_id for r in rows], [int(r.fingerprint, 16) for r in rows]
    groups = {}
    for i, root in zip(ids, classes(prints), strict=True):
        groups.setdefault(root, []).append(i)
    smallest = {i: min(g) for g in groups.values() for i in g}
    assert {r.doc_id: r.component_id for r in rows} == smallest


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = simhash.near_duplicates(df).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id]) for r in rows)
    check(rows)
    assert len({r.component_id for r in rows}) < len(rows)


def test_unusual_rows(spark):
    data = [(5, None, "", 0), (3, "", "", 0), (4, " \n", "", 0), (7, "one", "", 0), (8, "ONE", "", 0), (9, "É one two", "", 0)]
    rows = simhash.near_duplicates(spark.createDataFrame([*data, data[3], (None, "one", "", 0)], SCHEMA)).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == 8
    assert got == {5: 3, 3: 3, 4: 3, 7: 7, 8: 7, 9: 9, None: 7}
    assert {r.fingerprint for r in rows if r.doc_id == 3} == {"0" * 16}


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert simhash.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def family(rng, n, flips):
    centre = rng.getrandbits(64)
    return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)]


@pytest.mark.parametrize("dense", [8, 2048])
def test_links_are_complete(spark, dense):
    """Families around centres, split or not: the classes equal those of all pairs."""
    rng = random.Random(7)
    prints = sorted({p for n, k in ((400, 4), (200, 6), (60, 2), (10, 30)) for p in family(rng, n, k)})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), dense)
    found = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    groups = {}
    for p, root in zip(signed, classes(prints), strict=True):
        groups.setdefault(root, []).append(p)
    assert [found.get(p, p) for p in signed] == [min(g) for p in signed for g in groups.values() if p in g]


def test_near_components():
    rng = random.Random(1)
    prints = sorted({p for n, k in ((80, 3), (80, 8)) for p in family(rng, n, k)})
    signed = np.array(prints, dtype=np.uint64).view(np.int64)
    order, root = simhash.near_components(signed)
    groups = {}
    for p, g in zip(signed.tolist(), classes(prints), strict=True):
        groups.setdefault(g, []).append(p)
    assert dict(zip(order.tolist(), root.tolist(), strict=True)) == {p: min(g) for g in groups.values() for p in g}


def test_one_of_each_class_stays(spark):
    data = [(3, "a b c d", "x", 1), (2, "A b c  d", "y", 2), (9, "q r s", "z", 3), (9, "q r s", "z", 3), (None, "q r s", "n", 4), (None, "u", "m", 5)]
    rows = simhash.drop_near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.fp) for r in rows) == [(-1, "m", 5), (2, "y", 2), (9, "z", 3)]


def test_component_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
