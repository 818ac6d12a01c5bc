"""Ranked lexical search by presence masks.

Every item (a query text) looks for the documents that score highest over the item's terms.
Texts are cut into terms once; what is kept of a document is its length and the counts of
those terms that some item holds. The counts of documents per term follow, and with them
the weights.

The search works on batches of documents. A bitmap over the batch says for each term which
documents hold it. The bitmaps of an item's terms, turned on their side, give each document
its mask: which of the item's terms it holds. Documents with one mask form a group, and no
score in it exceeds the sum of the largest contributions of the mask's terms in the batch.
Groups are evaluated by descending bound, and as soon as the next bound is below the
lowest score that still ranks, the rest cannot matter. The ranking so far goes from
batch to batch within a task; a ranking of the tasks' rankings ends the search.

Items go to the tasks in blocks of at most BLOCK_TERMS terms (or one longer item), so what a
task holds is bounded; a larger benchmark takes more blocks, each a pass over the documents.

Rules for unusual rows: null and empty texts, and texts without terms, match nothing and are not
counted as documents; a null doc_id ranks after all others of the same score; repeated
documents are ranked each, repeated items (by id or by text) answered each, with a rank
of their own; an item without a known term has no rows. Other columns of both tables are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep

TOP = 50
BLOCK_TERMS = 50_000
PIECE = 1 << 22  # bytes of a text that are cut into terms at once
NO_ID = np.iinfo(np.int64).max
# ASCII letters and digits and everything beyond ASCII make terms; A-Z in lower case
_FOLD = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def count_terms(text: bytes | None) -> tuple[int, Counter]:
    """How many terms the text has, with repeats, and how often each."""
    folded, total, counts, at = (text or b"").translate(_FOLD), 0, Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        words = folded[at : end if end >= 0 else len(folded)].split()
        total += len(words)
        counts.update(words)
        at = end if end >= 0 else len(folded)
    return total, counts


def item_terms(items: DataFrame) -> DataFrame:
    """(slot, item_id, terms): the distinct terms of every item that has any; slot tells repeated items apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            terms = [sorted(count_terms(text)[1]) for text in texts]
            yield pa.record_batch([ids, pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    found = items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "item_id long, terms array<binary>")
    found = keep(found.where(F.size("terms") > 0), "mask-items")
    return keep(found.select(F.monotonically_increasing_id().alias("slot"), "*"), "mask-slots")


def document_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts): the length of each text that has terms, and the counts of the vocabulary's (by number)."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            lengths, ends, terms, counts = [], [0], [], []
            for text in batch.column(1):
                total, found = count_terms(text.as_py())
                lengths.append(total)
                for term in found.keys() & known.keys():
                    terms.append(known[term])
                    counts.append(found[term])
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.record_batch([batch.column(0), pa.array(lengths, pa.int64()), *arrays], ["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>").where("n > 0")


class Block:
    """A batch of documents by term: postings, contributions, the largest of each term, and a bitmap each."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, documents: int, length: int):
        self.ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy(zero_copy_only=False)
        lists = batch.column(2)
        terms, counts = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
        rows = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(terms, kind="stable")
        terms, counts, rows = terms[order], counts[order], rows[order]
        norm = 100 - 50 + (50 * n * documents) // length
        self.rows = rows
        self.gains = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm[rows]))
        self.terms, starts = np.unique(terms, return_index=True)
        self.starts = np.append(starts, len(terms))
        self.most = np.maximum.reduceat(self.gains, starts) if len(terms) else self.gains
        self.size = len(n)

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Where the wanted terms stand among those of the batch; terms it does not hold are left out."""
        if not len(self.terms):
            return wanted[:0]
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return at[self.terms[at] == wanted]

    def postings(self, place: int) -> slice:
        return slice(self.starts[place], self.starts[place + 1])

    def groups(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents with any of the terms, the number of each one's mask, and the largest possible score of each mask."""
        bits = np.zeros((len(places), self.size), dtype=bool)
        for bit, place in zip(bits, places, strict=True):
            bit[self.rows[self.postings(place)]] = True
        found = np.flatnonzero(bits.any(axis=0))
        packed = np.packbits(bits[:, found].T, axis=1)
        words = np.zeros((len(found), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
        words[:, : packed.shape[1]] = packed
        words = words.view(np.uint64)
        if words.shape[1] == 1:
            _, first, mask = np.unique(words[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, mask = np.unique(words, axis=0, return_index=True, return_inverse=True)
        bounds = bits[:, found[first]].T.astype(np.int64) @ self.most[places]
        return found, mask.ravel(), bounds

    def scores(self, places: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen documents."""
        wanted = np.zeros(self.size, dtype=bool)
        wanted[chosen] = True
        total = np.zeros(self.size, dtype=np.int64)
        for place in places:
            part = self.postings(place)
            rows = self.rows[part]
            held = wanted[rows]
            total[rows[held]] += self.gains[part][held]
        return total[chosen]


class Ranking:
    """The highest scores of one item so far, equal ones by ascending id."""

    def __init__(self, top: int):
        self.top, self.ids, self.scores = top, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A document below this cannot rank any more."""
        return max(int(self.scores[-1]), 1) if len(self.scores) == self.top else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.least
        ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.ids, self.scores = ids[order], scores[order]

    def search(self, block: Block, terms: np.ndarray) -> int:
        """Evaluate the masks of the batch by descending bound until the rest is below the ranking; returns how many documents were scored."""
        places = block.places(terms)
        if not len(places) or block.most[places].sum() < self.least:
            return 0
        rows, mask, bounds = block.groups(places)
        order = np.argsort(-bounds, kind="stable")
        turn = np.empty(len(order), dtype=np.int64)
        turn[order] = np.arange(len(order))
        by_turn = rows[np.argsort(turn[mask], kind="stable")]
        ends = np.cumsum(np.bincount(turn[mask], minlength=len(order)))
        at = done = 0
        step = self.top
        while at < len(order) and bounds[order[at]] >= self.least:
            # whole masks, as many as hold the next `step` documents, but none below the ranking
            last = min(int(np.searchsorted(ends, done + step)) + 1, len(order))
            last = at + int(np.count_nonzero(bounds[order[at:last]] >= self.least))
            chosen = by_turn[done : ends[last - 1]]
            self.add(block.ids[chosen], block.scores(places, chosen))
            at, done, step = last, int(ends[last - 1]), 2 * step
        return done


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's highest-scoring documents with a score above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    items = item_terms(items)
    blocks = -(-(items.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    out = None
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("slot"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        vocabulary = sorted({bytes(term) for row in rows for term in row.terms})
        found = _rank_block(docs, rows, vocabulary, top)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "slot long, item_id long, doc_id long, score long")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _rank_block(docs: DataFrame, items: list, vocabulary: list[bytes], top: int) -> DataFrame:
    """(slot, item_id, doc_id, score): the rankings of the tasks for one block of items."""
    spark = docs.sparkSession
    table = keep(document_terms(docs, vocabulary), "mask-documents")
    documents, length = table.agg(F.count("*"), F.sum("n")).first()
    held = table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for row in held:
        df[row["term"]] = row["count"]
    # the logarithm of a term that no document holds is never used
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    number = {term: i for i, term in enumerate(vocabulary)}
    asked = [(row.slot, row.item_id, np.array(sorted(number[bytes(t)] for t in row.terms), dtype=np.int32)) for row in items]
    model = spark.sparkContext.broadcast((weights, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked = model.value
        rankings = [Ranking(top) for _ in asked]
        for batch in batches:
            block = Block(batch, weights, documents, length)
            for ranking, (_, _, terms) in zip(rankings, asked, strict=True):
                ranking.search(block, terms)
        sizes = [len(r.ids) for r in rankings]
        ids = np.concatenate([r.ids for r in rankings])
        columns = [
            pa.array(np.repeat([slot for slot, _, _ in asked], sizes), pa.int64()),
            pa.array(np.repeat(np.array([i for _, i, _ in asked], dtype=object), sizes), pa.int64()),
            pa.array(ids, pa.int64(), mask=ids == NO_ID),
            pa.array(np.concatenate([r.scores for r in rankings]), pa.int64()),
        ]
        yield pa.record_batch(columns, ["slot", "item_id", "doc_id", "score"])

    return table.mapInArrow(run, "slot long, item_id long, doc_id long, score long")


RANK_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id
), corpus AS (SELECT count(*) AS total, sum(n)::BIGINT AS len FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, corpus GROUP BY term
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // len))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
