import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import resampling

DOCS = "doc_id long, text string, quality int, key string"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in resampling.resample(docs, labels).collect()}
    assert len(rows) == docs.count()
    held = [(rows[r.doc_id].selected, r.quality) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].held_out]
    assert np.mean([s for s, q in held if q == 1]) > 0.95
    assert np.mean([s for s, q in held if q == 0]) < 0.1


@pytest.mark.parametrize("few", [1, 50, 20_000])
def test_threshold_is_the_kth_largest(spark, few, monkeypatch):
    monkeypatch.setattr(resampling, "FEW", few)
    rng = random.Random(3)
    values = [rng.gauss(0, 1) ** 3 for _ in range(3000)] + [0.25] * 500 + [1e9, -1e12]
    df = spark.createDataFrame([(v,) for v in values], "key double").repartition(4)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 400, 1700, 3501, 3502):
        assert resampling.threshold(df, "key", k) == (ordered[k - 1] if k < len(values) else float("-inf"))
    assert resampling.threshold(df, "key", 0) == float("inf")


@pytest.mark.parametrize("effective", [None, 60.0])
def test_weights_equal_plain_counting(spark, effective):
    docs = [(i, " ".join(random.Random(i).choices("ab cd ef gh ## || ij".split(), k=20)), 0, "") for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(40)]
    rows = {r.doc_id: r for r in resampling.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), share=0.5, effective=effective).collect()}
    features = resampling.Features()
    raw, target = Counter(), Counter()
    for i, text, *_ in docs:
        raw.update(features.of(text).tolist())
        if i < 40 and i % 2 and not rows[i].held_out:
            target.update(features.of(text).tolist())
    n, m, b = sum(raw.values()), sum(target.values()), resampling.BUCKETS
    for i, text, *_ in docs:
        logs = []
        for f in features.of(text).tolist():
            p = (raw[f] + 1) / (n + b)
            logs.append(math.log((target[f] + p * b) / (m + b) / p))
        assert rows[i].log_weight == pytest.approx(sum(logs) / len(logs) * effective if effective else sum(logs))
    chosen = sorted((r.key for r in rows.values()), reverse=True)[:30]
    assert sorted((r.key for r in rows.values() if r.selected), reverse=True) == chosen


def test_gumbel_noise(spark):
    noise = [r.g for r in spark.range(20_000).select(resampling.gumbel(F.col("id"), 1).alias("g")).collect()]
    assert np.mean(noise) == pytest.approx(0.5772, abs=0.03)
    assert np.var(noise) == pytest.approx(math.pi**2 / 6, abs=0.06)


def test_unusual_rows(spark):
    docs = [(1, None, 0, ""), (2, "", 0, ""), (3, "a b", 0, ""), (3, "a b", 0, ""), (None, "a", 0, ""), (4, "w " * 50_000, 0, "")]
    none = spark.createDataFrame([], LABELS)
    rows = resampling.resample(spark.createDataFrame(docs, DOCS), none).collect()
    assert len(rows) == 6 and all(r.selected and r.log_weight == 0 for r in rows)
    labels = spark.createDataFrame([(3, None, 0), (None, 1, 0), (4, 1, 0)], LABELS)
    rows = resampling.resample(spark.createDataFrame(docs, DOCS), labels, share=0.5).collect()
    assert len(rows) == 6 and all(math.isfinite(r.key) for r in rows)
    assert resampling.resample(spark.createDataFrame([], DOCS), none).collect() == []
