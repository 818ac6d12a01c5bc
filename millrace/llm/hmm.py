"""Sequence likelihood by a hidden Markov model trained with Baum-Welch on Spark.

Texts are lower-cased (A-Z), cut at ASCII white space and closed by one end token.
The scan turns them into blocks: a dictionary of the block's words and the texts as
positions in it. Dictionaries are dealt out by a hash of the word, counts of all training
words are added up, and each block gets those of its own words back. So no task ever
holds the whole vocabulary, and a word travels once per block, not once per document.

The model draws a latent state per token, from the state a class of words, and from
the class a word by its count: P(w | k) = P(class | k) (c(w) - d) / N(class). Frequent
words are classed by a hash, rare ones by a hash of their last letters; the discount d
of all words together is the probability of the one event "unknown word". Every round
of Baum-Welch runs over all training tokens: tasks add expected counts, Spark sums them
by class, and the driver sees one row per class, a number fixed by parameter. The
scaled forward recursion gives the exact likelihood.

Rules for unusual rows: a null or empty text is its end token alone; a null doc_id is
kept (it counts as held out: crc32 of an empty text is 0); repeated rows count and are
returned once each; without any training text every token is unknown and all scores
are 0; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold_zero, keep, words_of

BLOCK_TOKENS = 1_000_000  # tokens of a block, unless one text is longer
BATCH_TOKENS = 250_000  # tokens that run through the recursions together
FREQUENT = 20  # occurrences from which a word is classed by itself
ENDING = 3  # last letters that class a rarer word
WORD_CLASSES, ENDING_CLASSES = 1 << 15, 1 << 13
ANCHORS = 128  # most frequent words, whose common documents give the first states
PRIOR = 200.0  # tokens by which each state is drawn to the corpus average
END = "\n"  # cannot be a word
PART_WORDS = 400_000  # dictionary entries added up in one call, on average

BLOCK = "block long, ids array<string>, held array<boolean>, lengths array<int>, codes binary, words array<string>, counts array<long>"


def squeezed(codes: np.ndarray) -> bytes:
    """Codes as compressed planes of bytes: the upper ones are nearly empty."""
    planes = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _blocks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    base, number = TaskContext.get().partitionId() << 32, 0
    book: dict[bytes, int] = {END.encode(): 0}
    codes, ids, held, lengths, tokens = [], [], [], [], 0

    def row() -> pd.DataFrame:
        words = np.array(list(book), dtype=object)
        order = np.argsort(np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        joined = rank[np.concatenate(codes)]
        train = np.repeat(~np.array(held, dtype=bool), lengths)
        counts = np.bincount(joined[train], minlength=len(book))
        one = (base + number, ids, held, lengths, squeezed(joined), [w.decode() for w in words[order]], counts)
        return pd.DataFrame([one], columns=["block", "ids", "held", "lengths", "codes", "words", "counts"])

    for batch in batches:
        for doc_id, text, out in zip(batch["doc_id"], batch["text"], batch["held_out"], strict=True):
            words = words_of(text)
            words.append(END.encode())
            if tokens and tokens + len(words) > BLOCK_TOKENS:
                yield row()
                number, book, tokens = number + 1, {END.encode(): 0}, 0
                codes, ids, held, lengths = [], [], [], []
            codes.append(np.fromiter((book.setdefault(w, len(book)) for w in words), dtype=np.int32, count=len(words)))
            ids.append(doc_id)
            held.append(bool(out))
            lengths.append(len(words))
            tokens += len(words)
    if ids:
        yield row()


@dataclass
class Corpus:
    """Blocks with the counts (0: not in training) and classes (-1 then) of their words, and totals of the vocabulary."""

    blocks: DataFrame
    anchors: list[tuple[str, int]]  # the most frequent words and their classes
    tokens: int
    words: int
    discount: float
    class_tokens: np.ndarray
    class_words: np.ndarray


REQUEST = "part int, block long, at int, words string, counts binary"
ANSWER = (
    "part int, block long, at int, c binary, class binary,"
    " stats array<struct<class: int, c: long, v: long, n1: long, n2: long>>, top array<struct<c: long, word: string, class: int>>"
)


def _requests(parts: int):
    """Each block's dictionary, dealt out by a hash of the word: a row per block and part, not per word.

    A dictionary is in the order of that hash, so a part of it is one stretch, known by its first place.
    """

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for r in pdf.itertuples(index=False):
                words = np.asarray(r.words, dtype=object)
                counts = np.asarray(r.counts)
                crc = np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.int64, count=len(words))
                cuts = np.searchsorted(crc * parts >> 32, np.arange(parts + 1))
                rows = []
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if b > a:
                        rows.append((p, r.block, a, " ".join(words[a:b]), counts[a:b].astype("<i4").tobytes()))
                yield pd.DataFrame(rows, columns=["part", "block", "at", "words", "counts"])

    return run


def class_of(word: str, count: int) -> int:
    if count >= FREQUENT:
        return zlib.crc32(word.encode()) // 7 % WORD_CLASSES
    return WORD_CLASSES + zlib.crc32(word[-ENDING:].encode()) % ENDING_CLASSES


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Adds up the counts of one part's words over all blocks, and tells each block those of its own."""
    lists = [w.split(" ") for w in pdf["words"]]
    sizes = [len(x) for x in lists]
    number, unique = pd.factorize(np.array([w for x in lists for w in x], dtype=object))
    counts = np.concatenate([np.frombuffer(x, dtype="<i4") for x in pdf["counts"]])
    c = np.bincount(number, weights=counts, minlength=len(unique)).astype(np.int64)
    cls = np.fromiter((class_of(w, n) if n else -1 for w, n in zip(unique, c, strict=True)), dtype=np.int32, count=len(unique))
    rows, at, part = [], 0, int(pdf["part"].iloc[0])
    for r, n in zip(pdf.itertuples(index=False), sizes, strict=True):
        mine = number[at : at + n]
        rows.append((part, r.block, r.at, c[mine].astype("<i8").tobytes(), cls[mine].astype("<i4").tobytes(), None, None))
        at += n
    known = np.flatnonzero(c)
    names, inverse = np.unique(cls[known], return_inverse=True)
    sums = [np.bincount(inverse, weights=w, minlength=len(names)).astype(np.int64) for w in (c[known], c[known] > 0, c[known] == 1, c[known] == 2)]
    stats = [{"class": int(names[i])} | {k: int(s[i]) for k, s in zip(("c", "v", "n1", "n2"), sums, strict=True)} for i in range(len(names))]
    best = sorted(((int(c[i]), unique[i], int(cls[i])) for i in known[np.argsort(-c[known], kind="stable")[: 2 * ANCHORS]]), key=lambda x: (-x[0], x[1]))
    top = [{"c": n, "word": w, "class": k} for n, w, k in best[: ANCHORS + 1]]
    rows.append((part, None, None, None, None, stats, top))
    out = pd.DataFrame(rows, columns=["part", "block", "at", "c", "class", "stats", "top"])
    return out.astype({"block": "Int64", "at": "Int32"})


def corpus(docs: DataFrame, folds: int = 10) -> Corpus:
    picked = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        fold_zero(F.col("doc_id"), folds).alias("held_out"),
    )
    blocks = keep(picked.mapInPandas(_blocks, BLOCK), "hmm-blocks")
    entries = blocks.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    asked = blocks.select("block", "words", "counts").mapInPandas(_requests(max(1, -(-entries // PART_WORDS))), REQUEST)
    answers = keep(asked.groupBy("part").applyInPandas(_answer, ANSWER), "hmm-answers")
    # one row per class: at most WORD_CLASSES + ENDING_CLASSES
    sums = answers.select(F.inline("stats")).groupBy("class").agg(*[F.sum(x).alias(x) for x in ("c", "v", "n1", "n2")]).collect()
    class_tokens, class_words = np.zeros(WORD_CLASSES + ENDING_CLASSES), np.zeros(WORD_CLASSES + ENDING_CLASSES)
    for r in sums:
        class_tokens[r["class"]], class_words[r["class"]] = r.c, r.v
    once, twice = sum(r.n1 for r in sums), sum(r.n2 for r in sums)
    discount = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)
    top = answers.select(F.inline("top")).where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(ANCHORS).collect()
    # a block's answers are no longer than the block
    lists = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("at", "c", "class")).alias("answers"))
    coded = blocks.select("block", "ids", "held", "lengths", "codes", F.size("words").alias("n")).join(lists, "block")
    anchors = [(r.word, r["class"]) for r in top]
    return Corpus(keep(coded, "hmm-coded"), anchors, int(class_tokens.sum()), int(class_words.sum()), discount, class_tokens, class_words)


@dataclass
class Model:
    """start (K), move (K x K), emit (classes + 1 for unknown, K); `share` is the count-based part of a known word."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def emissions(per_class: np.ndarray, stats: Corpus) -> np.ndarray:
    """P(class | state), with the discount of every class moved to the event "unknown" in the last row.

    `per_class` (classes x states) holds expected tokens. A known word's probability is its
    class's row times (c - d) / N(class), so each state's probabilities add up to one.
    """
    average = stats.class_tokens / stats.class_tokens.sum()
    share = per_class + PRIOR * average[:, None]
    share /= share.sum(axis=0)
    gone = np.divide(stats.discount * stats.class_words, stats.class_tokens, out=np.zeros_like(average), where=stats.class_tokens > 0)
    return np.vstack([share, gone @ share])


def batches_of(lengths: np.ndarray, at_most: int = BATCH_TOKENS) -> Iterator[np.ndarray]:
    """Positions of texts, longest first, in batches of at most so many tokens (or of one text)."""
    order = np.argsort(-lengths, kind="stable")
    batch = (np.cumsum(lengths[order]) - 1) // at_most
    cuts = [0, *(np.flatnonzero(batch[1:] != batch[:-1]) + 1), len(order)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield order[a:b]


@dataclass
class Layout:
    """Tokens of a batch by time step: step t takes rows first[t] to first[t] + active[t], texts in the same order."""

    place: np.ndarray  # of the row's token in the block
    text: np.ndarray  # of the row
    first: list[int]
    active: list[int]

    @classmethod
    def of(cls, starts: np.ndarray, lengths: np.ndarray) -> Layout:
        """`lengths` must not rise."""
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        first = np.cumsum(active) - active
        text = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        row = first[step] + text
        place, owner = np.empty_like(row), np.empty_like(row)
        place[row], owner[row] = starts[text] + step, text
        return cls(place, owner, first.tolist(), active.tolist())


def forward(model: Model, emit: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion over the rows of a layout: state probabilities so far, and scales.

    The product of a text's scales is its likelihood.
    """
    alpha, scale = np.empty_like(emit), np.empty(len(emit))
    ones, move, before = np.ones(emit.shape[1]), model.move, 0
    for t, (a, n) in enumerate(zip(layout.first, layout.active, strict=True)):
        now, sums = alpha[a : a + n], scale[a : a + n]
        if t:
            np.matmul(alpha[before : before + n], move, out=now)
            now *= emit[a : a + n]
        else:
            np.multiply(emit[:n], model.start, out=now)
        np.matmul(now, ones, out=sums)
        now /= sums[:, None]
        before = a
    return alpha, scale


def log_likelihood(model: Model, cls: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 of each text's probability; `lengths` must not rise."""
    layout = Layout.of(starts, lengths)
    _, scale = forward(model, model.emit[cls[layout.place]], layout)
    return np.bincount(layout.text, weights=np.log10(scale), minlength=len(lengths))


def expected(model: Model, cls: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Expected first states and moves, each row's token and state probabilities, and the log10 likelihood."""
    layout = Layout.of(starts, lengths)
    emit = model.emit[cls[layout.place]]
    alpha, scale = forward(model, emit, layout)
    beta, back = np.ones_like(alpha), np.ascontiguousarray(model.move.T)
    steps = list(zip(layout.first, layout.active, strict=True))
    for (p, _), (a, n) in zip(steps[-2::-1], steps[:0:-1], strict=True):
        emit[a : a + n] *= beta[a : a + n]  # what follows, seen from the state before
        earlier = beta[p : p + n]
        np.matmul(emit[a : a + n], back, out=earlier)
        earlier /= scale[a : a + n, None]
    n = layout.active[0]
    later = np.arange(n, len(emit))
    step = np.repeat(np.arange(len(steps)), layout.active)[n:]
    prior = alpha[np.asarray(layout.first)[step - 1] + layout.text[later]]
    moves = (prior / scale[later, None]).T @ emit[later] * model.move
    alpha *= beta
    alpha /= alpha.sum(axis=1, keepdims=True)
    return alpha[:n].sum(axis=0), moves, layout.place, alpha, np.log10(scale).sum()


def _parts(pdf: pd.DataFrame) -> Iterator[tuple]:
    """(ids, held, lengths, starts, counts and classes per token) of each block."""
    for r in pdf.itertuples(index=False):
        codes = unsqueezed(r.codes)
        lengths = np.asarray(r.lengths, dtype=np.int64)
        c, cls = np.zeros(r.n, dtype=np.int64), np.full(r.n, -1, dtype=np.int32)
        for x in r.answers:
            counts = np.frombuffer(x["c"], dtype="<i8")
            place = slice(x["at"], x["at"] + len(counts))
            c[place], cls[place] = counts, np.frombuffer(x["class"], dtype="<i4")
        yield r.ids, np.asarray(r.held, dtype=bool), lengths, np.cumsum(lengths) - lengths, c[codes], cls[codes]


def baum_welch_round(stats: Corpus, model: Model) -> tuple[Model, float]:
    """One round over all training texts; also the log10 likelihood of the classes before it."""
    k, classes = len(model.start), len(stats.class_tokens)
    shared = stats.blocks.sparkSession.sparkContext.broadcast(model)  # classes x states, fixed by parameters

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        first, moves, total, log = np.zeros(k), np.zeros((k, k)), np.zeros((classes, k)), 0.0
        for pdf in pdfs:
            for _, held, lengths, starts, _, cls in _parts(pdf):
                train = np.flatnonzero(~held)
                for batch in batches_of(lengths[train]):
                    chosen = train[batch]
                    one, many, places, gammas, value = expected(m, cls, starts[chosen], lengths[chosen])
                    first, moves, log = first + one, moves + many, log + value
                    at = cls[places]
                    for s in range(k):
                        total[:, s] += np.bincount(at, weights=gammas[:, s], minlength=classes)
        seen = np.flatnonzero(total.any(axis=1))
        rows = np.vstack([total[seen], moves, first[None, :], np.full((1, k), log / k)])
        names = np.concatenate([seen, np.arange(-k - 2, 0)])
        yield pd.DataFrame({"class": names} | {f"s{s}": rows[:, s] for s in range(k)})

    columns = [f"s{s}" for s in range(k)]
    parts = stats.blocks.mapInPandas(run, "class int, " + ", ".join(f"{c} float" for c in columns))
    sums = parts.groupBy("class").agg(*[F.sum(c).alias(c) for c in columns]).collect()  # a row per class
    shared.unpersist()
    per_class, moves, first, log = np.zeros((classes, k)), np.zeros((k, k)), np.zeros(k), 0.0
    for r in sums:
        values = [r[c] for c in columns]
        if r["class"] >= 0:
            per_class[r["class"]] = values
        elif r["class"] < -2:
            moves[r["class"] + k + 2] = values
        elif r["class"] == -2:
            first = np.array(values)
        else:
            log = sum(values)
    move = moves + 1.0
    start = first + 1.0
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emissions(per_class, stats)), log


def first_states(stats: Corpus, k: int) -> Model:
    """States to begin with, from how often the most frequent words share a training document.

    One pass over all documents gives a matrix of ANCHORS x ANCHORS; its leading
    eigenvectors put words of like company together, and each group of words marks a state.
    """
    top, classes = stats.anchors, len(stats.class_tokens)
    number = np.full(classes + 1, -1)
    for i, (_, place) in enumerate(top):
        number[place] = i
    m = max(len(top), 1)
    shared = stats.blocks.sparkSession.sparkContext.broadcast(number)

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        together = np.zeros((m, m))
        for pdf in pdfs:
            for _, held, lengths, _, _, cls in _parts(pdf):
                doc = np.repeat(np.arange(len(lengths)), lengths)
                anchor = shared.value[cls]
                use = (anchor >= 0) & ~held[doc]
                has = np.zeros((len(lengths), m), dtype=np.float32)
                has[doc[use], anchor[use]] = 1
                together += has.T @ has
        i, j = np.nonzero(together)
        yield pd.DataFrame({"i": i, "j": j, "n": together[i, j]})

    parts = stats.blocks.mapInPandas(run, "i int, j int, n double")
    together = np.zeros((m, m))
    for r in parts.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # at most ANCHORS squared
        together[r.i, r.j] = r.n
    alone = np.sqrt(np.maximum(np.diag(together), 1))
    _, vectors = np.linalg.eigh(together / alone[:, None] / alone[None, :])
    points = vectors[:, -k:]
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    chosen = [0]  # spread out from the most frequent word
    while len(chosen) < min(k, m):
        chosen.append(int(np.argmin((points @ points[chosen].T).max(axis=1))))
    centres = points[chosen]
    for _ in range(10):
        group = np.argmax(points @ centres.T, axis=1)
        centres = np.stack([points[group == g].sum(axis=0) if (group == g).any() else c for g, c in enumerate(centres)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    boost = np.ones((classes, k))
    for i, (_, place) in enumerate(top):
        boost[place] = np.where(np.arange(k) == group[i], 4.0, 0.25)
    move = np.full((k, k), 0.1 / k) + 0.9 * np.eye(k)
    return Model(np.full(k, 1 / k), move, emissions(stats.class_tokens[:, None] * boost, stats))


def train(stats: Corpus, states: int = 8, rounds: int = 3) -> Model:
    model = first_states(stats, states)
    for _ in range(rounds):
        model, _ = baum_welch_round(stats, model)
    return model


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, states: int = 8, rounds: int = 3, folds: int = 10) -> DataFrame:
    """One row per document: sizes, the unigram base score and the model's log10 probability of the text."""
    stats = corpus(docs, folds)
    n, v, d = stats.tokens, stats.words, stats.discount
    model = train(stats, states, rounds) if n else None
    shared = docs.sparkSession.sparkContext.broadcast((model, np.append(stats.class_tokens, 1.0)))

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, class_tokens = shared.value
        for pdf in pdfs:
            for ids, held, lengths, starts, c, cls in _parts(pdf):
                known = c > 0
                base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
                total = np.zeros(len(lengths))
                if m:
                    # an unknown word is the last row of `emit` (class -1), with no further share
                    share = np.where(known, np.log10(np.maximum(c - d, 1e-300) / class_tokens[cls]), 0.0)
                    total = np.add.reduceat(share, starts)
                    for batch in batches_of(lengths):
                        total[batch] += log_likelihood(m, cls, starts[batch], lengths[batch])
                out = pd.DataFrame({"doc_id": list(ids), "held_out": held, "n_tokens": lengths})
                out["doc_id"] = out["doc_id"].astype("Int64")
                out["n_known"] = np.add.reduceat(known.astype(np.int64), starts)
                out["train_tokens"] = n
                out["base_score"] = np.add.reduceat(base, starts)
                out["score"] = total
                yield out

    return stats.blocks.mapInPandas(run, SCORES)
