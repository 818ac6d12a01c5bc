"""Quality by importance resampling: hashed n-gram models of wanted and of raw text.

Words and runs of signs, alone and in pairs, are hashed into a fixed number of buckets.
Bucket counts of all target documents and of all documents give two generative models;
a document's weight is the ratio of its probabilities under them. Sampling without
replacement in proportion to weights is a top-k of log weight plus Gumbel noise; the
noise is a hash of the id, so every run draws the same sample. The k-th largest value is
found by counting in ever finer intervals, never by sorting all documents in one place.

The ratio is that of the whole text's probabilities, so it grows with the text. On request
log weights are averaged per n-gram and scaled to a given number of n-grams, so that long
and short documents compete on what they are made of, not on length.

Raw text is counted in the scan. For the target model a filter of fixed size lets the texts pass
whose ids may be wanted, and these alone are joined with the wanted ids, by a shuffle at any size.

Rules for unusual rows: a null or empty text has log weight 0; a null doc_id is kept, with
the noise of an empty id; repeated rows get equal values, and rows equal to the k-th
largest value are all kept; labels that are null do not count; other columns are
ignored. Without target documents all log weights are 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import filter_of, fold_zero, keep

BUCKETS = 1 << 16
SMOOTHING = 1.0  # counts added to the target model per bucket, in proportion to the raw model
FEW = 20_000  # values that the driver may sort to end the search for the threshold
TOKEN = re.compile(r"\w+|[^\w\s]+")


class Features(dict):
    """Token to 64-bit hash, remembered for a bounded number of tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token.encode(), 11)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Buckets of all words and pairs of neighbours."""
        tokens = TOKEN.findall(text.lower()) if text else []
        one = np.fromiter(map(self.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
        both = np.concatenate([one, two ^ two >> np.uint64(32)])
        return (both % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of the n-grams of all rows (text) by bucket; one row per bucket comes to the driver."""

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, total = Features(), np.zeros(BUCKETS, dtype=np.int64)
        for pdf in pdfs:
            for i in range(0, len(pdf), 256):
                total += np.bincount(np.concatenate([features.of(t) for t in pdf["text"].iloc[i : i + 256]]), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    counts = np.zeros(BUCKETS)
    for r in texts.select("text").mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log of target over raw probability per bucket; both models are smoothed towards all text."""
    if not target.sum():
        return np.zeros(BUCKETS)
    p = (raw + 1) / (raw.sum() + BUCKETS)
    q = (target + SMOOTHING * p * BUCKETS) / (target.sum() + SMOOTHING * BUCKETS)
    return np.log(q / p)


def threshold(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, exactly: counts per interval narrow it down, the last few values are sorted."""
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0  # values larger than `high`'s interval
    while n > FEW and low < high:
        step = (high - low) / 1024
        if not step:
            break
        inside = values.where(F.col(column).between(low, high))
        # rising with the value, whatever the rounding; the smallest and the largest value part ways
        number = F.least(F.floor((F.col(column) - low) / step).cast("int"), F.lit(1023))
        rows = inside.groupBy(number.alias("i")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(rows.collect(), key=lambda r: -r.i):  # 1024 rows at most
            if above + r.n >= k:
                low, high, n = r.low, r.high, r.n
                break
            above += r.n
    if low == high:
        return low
    rest = values.where(F.col(column).between(low, high)).orderBy(F.desc(column)).limit(k - above).collect()
    return rest[-1][column]


def gumbel(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the id, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, folds: int = 5, seed: int = 17, effective: float | None = None) -> DataFrame:
    """(doc_id, held_out, log_weight, key, selected): one row per document.

    Target text is what labels call good (quality 1) outside the held-out fold. `share` is
    the part of all documents to draw; by default that of good ones among these labels.
    With `effective` log weights are means per n-gram times that number.
    """
    tags = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~fold_zero(F.col("doc_id"), folds))
    tags = tags.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    good = keep(tags.where("quality = 1").select("id"), "resampling-target")
    raw = bucket_counts(texts)
    wanted = texts.where(F.col("id").isNotNull() & filter_of(good, "id")).join(good.hint("merge"), "id")
    target = bucket_counts(wanted)
    if share is None:
        share = tags.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        share = 1.0 if share is None else share
    ratio = docs.sparkSession.sparkContext.broadcast(log_ratio(raw, target))  # BUCKETS values

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        features, out = Features(), np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = features.of(text)
            if len(found):
                values = ratio.value[found]
                out[i] = values.sum() if effective is None else values.mean() * effective
        return pd.Series(out)

    doc_id = F.col("doc_id").cast("long")
    scored = docs.select(doc_id.alias("doc_id"), fold_zero(doc_id, folds).alias("held_out"), weight(F.col("text").cast("string")).alias("log_weight"))
    scored = keep(scored.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "resampling-keys")
    least = threshold(scored, "key", round(share * scored.count()))
    return scored.withColumn("selected", F.col("key") >= least)
