"""Toxicity by weak supervision: many voters, a label model of them, a linear classifier.

Voters are terms (words or beginnings of words, counted at least once, twice or three
times) and patterns of several terms. The terms are a short fixed list and those that
training labels point to. Every document's counts are taken in one pass and stored;
the votes of all training documents, grouped by equal votes, go into a generative model:
a latent class, a reliability per voter and class, and the voters' correlations within
each class, by which votes that say the same thing twice are discounted. Labels are one
more voter there. A logistic classifier is then trained on the posterior labels of a
bounded sample of labelled rows, and scores every document.

Rules for unusual rows: a null or empty text has no terms and gets the classifier's
score of that; a null doc_id is kept, never joins a label and counts as held out (crc32
of an empty text is 0); repeated rows are scored each; of several labels for an id the
largest counts, null labels do not; of several texts for a labelled id the smallest
teaches; other columns are ignored. Without any positive label only the fixed terms vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.llm.common import fold_zero, keep

# words that insult in plain English; a starting list, extended from labels
FIXED_TERMS = [
    "idiot", "moron", "stupid", "scum", "loser", "trash", "clown", "pathetic", "worthless", "disgusting",
    "imbecile", "bastard", "vermin", "filthy", "subhuman",
]
LETTERS = re.compile(r"[^\W\d_]+")
STEMS = range(4, 9)  # lengths of beginnings that may become terms
SAMPLE = 12_000  # labelled training rows that terms and classifier are fitted on
SUPPORT = 5  # positive rows a mined term needs
LEVELS = (1, 2, 3)
GOLD = 0.97  # reliability given to a label
PATTERNS = 5  # voters over several terms
SHARE = 0.01  # of the toxic rows that a term must mark to stay beside others that mark the same rows
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)  # odd multipliers of shingle hashes


@dataclass(frozen=True)
class Term:
    """A word (whole) or a beginning of words, voting when it occurs at least `level` times."""

    text: str
    level: int
    whole: bool = False


class TermCounter:
    """Counts all terms of a text in one scan."""

    def __init__(self, terms: list[Term]):
        import ahocorasick

        self._places: dict[tuple[str, bool], int] = {}
        for t in terms:
            self._places.setdefault((t.text, t.whole), len(self._places))
        self._scan = ahocorasick.Automaton()
        for text in {text for text, _ in self._places}:
            self._scan.add_word(text, text)
        if self._places:
            self._scan.make_automaton()
        self.width = len(self._places)
        self.column = [self._places[t.text, t.whole] for t in terms]

    def count(self, text: str | None) -> np.ndarray:
        out = np.zeros(self.width, dtype=np.int32)
        if not text or not self.width:
            return out
        low = text.lower()
        for end, term in self._scan.iter(low):
            start = end - len(term) + 1
            if start and low[start - 1].isalpha():
                continue
            if (at := self._places.get((term, False))) is not None:
                out[at] += 1
            if (at := self._places.get((term, True))) is not None and not low[end + 1 : end + 2].isalpha():
                out[at] += 1
        return out


def mine_terms(sample: DataFrame) -> list[Term]:
    """Terms that labelled rows (text, toxic) show to go with toxicity, best first.

    A term passes that has enough positive rows, is much more frequent among them,
    and is so beyond chance: with as many terms as were tested, not one of no meaning is
    expected to pass. Near copies count about once, or the words of a copied text would pass.
    Counts of documents per term, level and label are added up inside each task before
    they are grouped; only terms that pass reach the driver.
    """
    sample = keep(without_copies(sample.select("text", "toxic")), "toxicity-texts")

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for pdf in pdfs:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                one: Counter = Counter()
                for word, n in Counter(LETTERS.findall((text or "").lower())).items():
                    one[word, True] += n
                    for length in STEMS:
                        if length <= len(word):
                            one[word[:length], False] += n
                seen[int(toxic)].update((term, whole, level) for (term, whole), n in one.items() for level in LEVELS if n >= level)
        rows = [(*k, n if y else 0, 0 if y else n) for y in (0, 1) for k, n in seen[y].items()]
        yield pd.DataFrame(rows, columns=["term", "whole", "level", "pos", "neg"])

    parts = sample.select("text", "toxic").mapInPandas(run, "term string, whole boolean, level int, pos long, neg long")
    total = sample.groupBy("toxic").count().collect()
    positives = sum(r["count"] for r in total if r.toxic)
    negatives = sum(r["count"] for r in total if not r.toxic)
    if not positives:
        return []
    p, n = F.col("pos"), F.col("neg")
    # against even numbers of both labels
    rate_p, rate_n = (p + 0.5) / (positives + 1.0), (n + 0.5) / (negatives + 1.0)
    # a term of no meaning has p or more positive rows with a probability of at most exp(-surprise)
    base = positives / (positives + negatives)
    surprise = p * F.log(p / (p + n) / base) + F.when(n > 0, n * F.log(n / (p + n) / max(1 - base, 1e-9))).otherwise(0.0)
    sums = parts.groupBy("term", "whole", "level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(p + n >= SUPPORT)
    sums = keep(sums, "toxicity-terms")
    best = sums.where((p >= SUPPORT) & (rate_p > 6 * rate_n) & (F.exp(surprise) >= sums.count()))
    return covering(sample, best.collect(), 6 * positives / max(negatives, 1))


def without_copies(sample: DataFrame) -> DataFrame:
    """Of rows (text, toxic) with the same label whose texts share a smallest shingle hash, the one with the smallest text."""

    @F.pandas_udf("array<long>")
    def least(texts: pd.Series) -> pd.Series:
        return pd.Series([least_hashes(t) for t in texts])

    rows = sample.distinct().withColumn("least", least("text"))
    for i in range(len(MIXERS)):
        rows = rows.groupBy(F.get("least", F.lit(i)).alias("h"), "toxic").agg(F.min(F.struct("text", "least")).alias("r")).select("toxic", "r.*")
    return rows.select("text", "toxic")


def least_hashes(text: str | None) -> list[int]:
    """The smallest hash of a text's shingles of five words, once per mixer; a text of fewer words is one shingle."""
    words = np.array([crc32(w.encode()) for w in (text or "").lower().split()], dtype=np.uint64)
    words = np.concatenate([words, np.zeros(max(5 - len(words), 0), dtype=np.uint64)])
    shingles = np.zeros(len(words) - 4, dtype=np.uint64)
    for i in range(5):
        shingles = (shingles + words[i : len(words) - 4 + i]) * MIXERS[0]
        shingles ^= shingles >> np.uint64(29)
    return [int((((shingles ^ (shingles >> np.uint64(32))) * m) ^ m).view(np.int64).min()) for m in MIXERS]


def covering(sample: DataFrame, rows: list[Row], ratio: float) -> list[Term]:
    """From the most telling term on: those whose documents are mostly toxic, and those that find further toxic documents.

    A term stays if it shows toxicity in documents without any earlier term. It stays also
    if a single occurrence means a toxic document more often than not, for a SHARE of the
    toxic ones, unless it is a beginning of an earlier term or begins with one. There is
    no limit to their number.
    """
    rows = sorted(rows, key=lambda r: (-(r.pos + 0.5) / (r.neg + 0.5), r.level, r.whole, -len(r.term), r.term))
    terms = [Term(r.term, r.level, r.whole) for r in rows]

    @F.pandas_udf("binary")
    def occurs(texts: pd.Series) -> pd.Series:
        counter, levels = TermCounter(terms), np.array([t.level for t in terms])
        return pd.Series([packed((counter.count(t)[counter.column] >= levels)[None, :])[0] for t in texts])

    found = sample.select("toxic", occurs("text").alias("mask")).toPandas() if terms else None  # at most a row per sampled id
    chosen: list[Term] = []
    if found is None:
        return chosen
    masks, toxic = np.stack([np.frombuffer(m, dtype=np.uint8) for m in found["mask"]]), found["toxic"].to_numpy() == 1
    uncovered = np.ones(len(toxic), dtype=bool)
    for i, term in enumerate(terms):
        mine = (masks[:, i >> 3] >> (7 - (i & 7)) & 1).astype(bool)
        pos, neg = np.count_nonzero(mine & uncovered & toxic), np.count_nonzero(mine & uncovered & ~toxic)
        own = term.level == 1 and rows[i].pos > max(rows[i].neg, SHARE * np.count_nonzero(toxic))
        own = own and not any(c.text.startswith(term.text) or term.text.startswith(c.text) for c in chosen)
        if own or (pos >= SUPPORT and pos > ratio * neg):
            chosen.append(term)
            uncovered &= ~mine
    return chosen


def term_counts(docs: DataFrame, terms: list[Term], folds: int, *extra: str) -> DataFrame:
    """(doc_id, held_out, words, counts of each different term text) per row of docs."""

    @F.pandas_udf("words int, counts array<int>")
    def run(texts: pd.Series) -> pd.DataFrame:
        counter = TermCounter(terms)
        return pd.DataFrame({"words": [word_count(t) for t in texts], "counts": [counter.count(t) for t in texts]})

    found = run(F.col("text").cast("string"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold_zero(F.col("doc_id"), folds).alias("held_out"), found.alias("f"), *extra)
    return named.select("doc_id", "held_out", "f.words", "f.counts", *extra)


def features(terms: list[Term], counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Columns for the classifier: how often each term occurs, and patterns over all terms."""
    patterns = pattern_votes(terms, counts, words)
    steps = [counts >= level for level in LEVELS]
    return np.hstack([*steps, patterns]).astype(np.float64)


def pattern_votes(terms: list[Term], counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Voters that look at several terms: any, two different ones, three hits, a high share of the words, none."""
    hits = counts.sum(axis=1)
    kinds = (counts > 0).sum(axis=1)
    share = hits / np.maximum(words, 1)
    return np.stack([kinds >= 2, hits >= 3, share >= 0.01, share >= 0.05, hits == 0], axis=1)


def votes(terms: list[Term], column: list[int], counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    levels = np.array([t.level for t in terms], dtype=np.int64)
    single = counts[:, column] >= levels[None, :] if terms else np.zeros((len(counts), 0), dtype=bool)
    return np.hstack([single, pattern_votes(terms, counts, words)])


@dataclass
class LabelModel:
    """P(vote | class) per voter (2 x M), weights that discount correlated voters, P(toxic)."""

    rate: np.ndarray
    weight: np.ndarray
    prior: float

    def posterior(self, bits: np.ndarray, gold: np.ndarray) -> np.ndarray:
        """P(toxic | votes); gold is 1, 0, or -1 for no label, and counts as a voter of reliability GOLD."""
        log = np.log(self.rate), np.log1p(-self.rate)
        both = [bits @ (log[0][y] * self.weight) + ~bits @ (log[1][y] * self.weight) for y in (0, 1)]
        odds = both[1] - both[0] + np.log(self.prior / (1 - self.prior))
        sure = np.log(GOLD / (1 - GOLD))
        return 1 / (1 + np.exp(-np.clip(odds + np.where(gold == 1, sure, np.where(gold == 0, -sure, 0.0)), -30, 30)))


def fit_label_model(grouped: DataFrame, voters: int, prior: float, rounds: int = 8) -> LabelModel:
    """EM over equal votes (mask binary, gold int, n long) of all training documents.

    A round sends M + M x M sums per task to the driver, whatever the number of documents.
    """
    start = np.where(np.arange(voters) < voters - 1, 0.02, 0.95)  # the last voter says "no term at all"
    rate = np.stack([start, np.where(np.arange(voters) < voters - 1, 0.2, 0.2)])
    model = LabelModel(rate, np.ones(voters) / max(np.sqrt(voters), 1), prior)
    names = ["y0", "y1"]

    for _ in range(rounds):
        current = model

        def run(pdfs: Iterable[pd.DataFrame], current: LabelModel = current) -> Iterator[pd.DataFrame]:
            mass, pairs = np.zeros(2), np.zeros((2, voters, voters))
            for pdf in pdfs:
                bits = unpack(pdf["mask"], voters)
                p = current.posterior(bits, pdf["gold"].to_numpy())
                for y, w in enumerate((1 - p, p)):
                    w = w * pdf["n"].to_numpy()
                    mass[y] += w.sum()
                    pairs[y] += (bits * w[:, None]).T @ bits
            flat = [np.append(pairs[y].ravel(), mass[y]) for y in (0, 1)]
            yield pd.DataFrame({"i": np.arange(voters * voters + 1)} | dict(zip(names, flat, strict=True)))

        sums = grouped.mapInPandas(run, "i int, y0 double, y1 double").groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()
        total = np.zeros((2, voters * voters + 1))
        for r in sums:
            total[:, r.i] = r.y0, r.y1
        mass, pairs = total[:, -1], total[:, :-1].reshape(2, voters, voters)
        joint = (pairs + 0.01) / (mass[:, None, None] + 1)
        rate = np.clip((np.diagonal(pairs, axis1=1, axis2=2) + 0.1) / (mass[:, None] + 1), 1e-5, 1 - 1e-5)
        spread = np.sqrt(rate * (1 - rate))
        # correlation within a class, the stronger of the two; a voter shares its weight with those that repeat it
        correlation = np.clip((joint - rate[:, :, None] * rate[:, None, :]) / (spread[:, :, None] * spread[:, None, :]), 0, 1)
        together = correlation.max(axis=0)
        np.fill_diagonal(together, 1)
        model = LabelModel(rate, 1 / together.sum(axis=1), float(np.clip(mass[1] / max(mass.sum(), 1), 0.005, 0.5)))
    return model


def packed(bits: np.ndarray) -> list[bytes]:
    """Votes as bits, eight to the byte; any number of voters."""
    return [row.tobytes() for row in np.packbits(bits.astype(bool), axis=1)]


def unpack(mask: pd.Series, voters: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(mask), dtype=np.uint8).reshape(len(mask), -(-voters // 8))
    return np.unpackbits(rows, axis=1, count=voters).astype(bool)


def fit_logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Newton steps of a logistic regression on soft targets; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, damp = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    damp[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (target - p) - damp * w
        hessian = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(damp)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, sample: int) -> DataFrame:
    """(doc_id, text, label): at most `sample` labelled ids outside the held-out fold, in the order of a hash."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    ids = ids.where(~fold_zero(F.col("doc_id"), folds))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias(column))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", column).agg(F.min("text").alias("text"))


@dataclass
class Scorer:
    """The trained classifier: terms, and weights of their features (or the label model, without labels)."""

    terms: list[Term]
    column: list[int]
    model: LabelModel
    weights: np.ndarray | None

    def probability(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return self.model.posterior(votes(self.terms, self.column, counts, words), np.full(len(counts), -1))
        linear = features(self.terms, counts, words) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(linear, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> tuple[Scorer, DataFrame]:
    """The scorer, and the stored counts of all documents that its label model was estimated on."""
    rows = keep(labelled_sample(docs, labels, "toxic", folds, sample), "toxicity-sample")
    mined = mine_terms(rows)
    taken = {(t.text, t.whole) for t in mined}
    terms = mined + [Term(t, 1, True) for t in FIXED_TERMS if (t, True) not in taken]
    column = TermCounter(terms).column
    counted = keep(term_counts(docs, terms, folds), "toxicity-counts")
    gold = term_counts(rows, terms, folds, "toxic").toPandas()  # at most `sample` rows
    voters = len(terms) + PATTERNS

    @F.pandas_udf("binary")
    def mask(counts: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series(packed(votes(terms, column, stack(counts), words.to_numpy())))

    train = counted.where(~F.col("held_out")).groupBy(mask("counts", "words").alias("mask")).agg(F.count("*").alias("n"))
    grouped = train.select("mask", F.lit(-1).alias("gold"), "n")
    weights, prior = None, 0.05
    if len(gold):
        y = gold["toxic"].to_numpy(dtype=np.int64)
        counts, words = stack(gold["counts"]), gold["words"].to_numpy()
        known = votes(terms, column, counts, words)
        prior = float(np.clip(y.mean(), 0.01, 0.5))
        labelled = pd.DataFrame({"mask": packed(known), "gold": y, "n": 1}).groupby(["mask", "gold"], as_index=False).sum()
        grouped = grouped.union(docs.sparkSession.createDataFrame(labelled, "mask binary, gold int, n long"))
    model = fit_label_model(keep(grouped, "toxicity-votes"), voters, prior)
    if len(gold):
        weights = fit_logistic(features(terms, counts, words), model.posterior(known, y))
    return Scorer(terms, column, model, weights), counted


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    scorer, counted = fit(docs, labels, folds, sample)

    @F.pandas_udf("double")
    def toxic(counts: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series(scorer.probability(stack(counts), words.to_numpy()))

    scored = counted.select("doc_id", "held_out", toxic("counts", "words").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose text scores below one half, all columns as they came."""
    scorer, _ = fit(docs, labels, folds, sample)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        counter = TermCounter(scorer.terms)
        counts = np.array([counter.count(t) for t in texts], dtype=np.int64).reshape(len(texts), -1)
        return pd.Series(scorer.probability(counts, np.array([word_count(t) for t in texts])))

    return docs.where(toxic(F.col("text").cast("string")) < 0.5)


def word_count(text: str | None) -> int:
    return text.count(" ") + text.count("\n") + 1 if text else 0


def stack(counts: pd.Series) -> np.ndarray:
    return np.array([np.asarray(c) for c in counts], dtype=np.int64).reshape(len(counts), -1)
