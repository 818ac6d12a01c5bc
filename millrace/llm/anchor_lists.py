"""Hard negatives from lists that the anchors of a cluster share.

Anchors are clustered by direction. For every cluster all rows are put into one list, once, by
descending upper bound of their inner product with any member: |x| cos(max(0, a - b)),
where a is the angle between x and the cluster's centre and b the largest angle between
the centre and a member. A member of length |m| can get no more than |m| times the bound
of the next entry from the rest of the list, so it walks from the top and stops as soon as that
is below what it still looks for. Members walk twice: for their positives (the highest
scores of the same label), and then, knowing these, for the negatives whose scores lie in the
window that each positive sets. Either walk ends certified or at the end of the list, so
results are exact however poor the bounds are.

On Spark a list is cut by rank into slices that grow geometrically, and a slice by hash into
chunks. A round is one slice: chunks meet the blocks of members that still walk, and each pair of
chunk and block is one call with a matrix product. Both sides of a call are bounded. Between
rounds only each member's best few rows are kept, in the shared folder.

Scores are integers. They come from products of doubles where these are exact, else from
64-bit products.

Rules for unusual rows: rows with a null id, label or vector, or a null or non-finite component
take no part; vectors are compared with those of their own length only; repeated rows count as
rows each; zero vectors score 0 with all. Equal scores go by smaller id. An anchor without positives
or without rows in a window has no result for them. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep

CLUSTERS = 4  # lists per vector length
SAMPLE = 4096  # anchors at most that the centres are fitted on; every anchor is assigned
SLICES = (1 / 16, 1 / 4, 1.0)  # ranks, as shares of a list, where slices end
CHUNK = 4096  # rows of a slice in a call
BLOCK = 512  # anchors in a call
PASSES = 8
SLACK = 1e-6  # of bounds, for the rounding of angles

FOUND = "anchor long, slot int, row long, id long, score long"


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.linalg.norm(vectors, axis=1) if vectors.size else np.zeros(len(vectors))


def fit_centres(vectors: np.ndarray, clusters: int) -> np.ndarray:
    """Unit centres by k-means on directions; as many as there are different ones, if fewer."""
    norm = lengths(vectors)
    units = np.unique(vectors[norm > 0] / norm[norm > 0, None], axis=0)
    if not len(units):
        return np.full((1, vectors.shape[1]), 1 / np.sqrt(max(vectors.shape[1], 1)))
    centres = units[np.random.default_rng(7).permutation(len(units))[:clusters]]
    for _ in range(PASSES):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.stack([units[nearest == c].sum(axis=0) for c in range(len(centres))])
        norm = lengths(sums)[:, None]
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles between all vectors and all centres; zero vectors stand at right angles to all."""
    norm = lengths(vectors)
    cosine = (vectors @ centres.T) / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


class Centres:
    """Centres by vector length; lengths that the sample did not hold get one centre."""

    def __init__(self, sample: list[np.ndarray], clusters: int):
        by_size: dict[int, list] = {}
        for vector in sample:
            by_size.setdefault(len(vector), []).append(vector)
        self.known = {size: fit_centres(np.stack(rows), clusters) for size, rows in by_size.items()}

    def of(self, size: int) -> np.ndarray:
        return self.known.get(size) if size in self.known else fit_centres(np.zeros((1, size)), 1)


def products(members: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, members by rows."""
    if members.size and rows.size:
        largest = float(np.abs(members.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max()) * members.shape[1]
        if largest < 2**53:
            return (members.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return (members @ rows.T).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the `count` highest allowed scores of each line; of equal ones the first columns."""
    lowest = np.iinfo(np.int64).min
    shown = np.where(allowed, scores, lowest)
    if shown.shape[1] > count:
        least = np.partition(shown, -count, axis=1)[:, -count]
        line, column = np.nonzero(allowed & (shown >= least[:, None]))
    else:
        line, column = np.nonzero(allowed)
    order = np.lexsort((column, -shown[line, column], line))
    line, column = line[order], column[order]
    rank = np.arange(len(line)) - np.searchsorted(line, line)
    return line[rank < count], column[rank < count]


def valid_rows(df: DataFrame, id_col: str, vector: Column, label: Column, is_anchor: Column) -> DataFrame:
    """(row, id, label, q, anchor): the rows that take part, numbered and stored."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull() & ~F.exists("q", lambda x: x.isNull()))
    return keep(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "anchor-rows")


def integer_vector(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors with a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    doubles = F.transform(vector, lambda x: x.cast("double"))
    return F.when(F.forall(doubles, finite), F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def assigned(rows: DataFrame, centres: Centres, block: int) -> DataFrame:
    """(anchor, id, label, q, length, cluster, angle, block): every anchor with its cluster, in blocks of about `block` members."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for size, part in pdf.groupby(pdf["q"].map(len)):
                vectors = np.stack(part["q"].to_list()).astype(np.float64)
                turn = angles(vectors, centres.of(size))
                nearest = turn.argmin(axis=1)
                yield part.assign(length=lengths(vectors), cluster=[f"{size}:{c}" for c in nearest], angle=turn[np.arange(len(part)), nearest])

    schema = "anchor long, id long, label long, q array<long>, length double, cluster string, angle double"
    found = rows.where("anchor").select(F.col("row").alias("anchor"), "id", "label", "q").mapInPandas(run, schema)
    found = keep(found, "anchor-assigned")
    sizes = found.groupBy("cluster").agg(F.ceil(F.count("*") / block).alias("blocks"))
    return found.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("anchor"), F.col("blocks")).cast("int")).drop("blocks")


def shared_lists(rows: DataFrame, centres: Centres, members: DataFrame, slices: tuple[float, ...], chunk: int) -> DataFrame:
    """(cluster, slice, chunk, bound, row, id, label, q): every row once in the list of every cluster of its length, sorted by descending bound."""
    spread = members.groupBy("cluster").agg(F.max("angle").alias("spread"))

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for size, part in pdf.groupby(pdf["q"].map(len)):
                vectors = np.stack(part["q"].to_list()).astype(np.float64)
                turn = angles(vectors, centres.of(size))
                for c in range(turn.shape[1]):
                    yield part.assign(length=lengths(vectors), cluster=f"{size}:{c}", angle=turn[:, c])

    schema = "row long, id long, label long, q array<long>, length double, cluster string, angle double"
    entries = rows.select("row", "id", "label", "q").mapInPandas(run, schema).join(F.broadcast(spread), "cluster")
    bound = F.col("length") * F.cos(F.greatest(F.lit(0.0), F.col("angle") - F.col("spread")))
    entries = keep(entries.select("cluster", (bound + F.col("length") * SLACK).alias("bound"), "row", "id", "label", "q"), "anchor-entries")
    # ends of the slices; any cut is right, an approximate rank is enough
    cuts = entries.groupBy("cluster").agg(
        F.count("*").alias("size"), F.percentile_approx(-F.col("bound"), [float(s) for s in slices[:-1]], 1000).alias("cuts")
    )
    entries = entries.join(F.broadcast(cuts), "cluster")
    number = F.size(F.filter("cuts", lambda cut: -F.col("bound") > cut))
    entries = entries.withColumn("slice", number)
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / chunk))
    entries = entries.withColumn("chunk", F.pmod(F.xxhash64("row"), chunks).cast("int"))
    entries = entries.select("cluster", "slice", "chunk", "bound", "row", "id", "label", "q")
    return keep(entries.repartition("cluster", "slice", "chunk").sortWithinPartitions("cluster", "slice", F.desc("bound")), "anchor-lists")


def walk(members: DataFrame, lists: DataFrame, goals: DataFrame, positives: bool, slices: int, count: int) -> DataFrame:
    """(anchor, slot, row, id, score): for each goal the `count` highest scores, found by walking the lists.

    A goal (anchor, slot, low, high) wants rows of the anchor's own label, itself left out, or
    of other labels, with scores from low to high.
    """
    spark = members.sparkSession
    bounds = lists.groupBy("cluster", "slice", "chunk").agg(F.max("bound").alias("top"))
    bounds = keep(bounds, "anchor-bounds")
    found = spark.createDataFrame([], FOUND)
    for number in range(slices):
        # what the rest of the list can still bring, against the last of what each goal has
        rest = bounds.where(F.col("slice") >= number).groupBy("cluster").agg(F.max("top").alias("rest"))
        state = found.groupBy("anchor", "slot").agg(F.count("*").alias("have"), F.min("score").alias("last"))
        open_goals = goals.join(state, ["anchor", "slot"], "left").join(members, "anchor").join(rest, "cluster")
        most = F.col("rest") * F.col("length") + SLACK
        certified = ((F.coalesce(F.col("have"), F.lit(0)) >= count) & (F.col("last") > most)) | (F.col("low") > most)
        open_goals = open_goals.where(~F.coalesce(certified, F.lit(False)))
        walkers = open_goals.groupBy("cluster", "block", "anchor").agg(
            F.any_value("id").alias("id"), F.any_value("label").alias("label"), F.any_value("q").alias("q"),
            F.collect_list(F.struct("slot", "low", "high", F.when(F.col("have") >= count, F.col("last")).alias("last"))).alias("goals"),
        )
        walkers = keep(walkers, "anchor-walkers")
        if walkers.isEmpty():
            break
        here = lists.where(F.col("slice") == number)
        blocks = walkers.select("cluster", "block").distinct()
        left = walkers.join(bounds.where(F.col("slice") == number).select("cluster", "chunk"), "cluster")
        right = here.join(blocks, "cluster").select("cluster", "block", "chunk", "row", "id", "label", "q")
        right = right.toDF("of", "part", "piece", "row", "id", "label", "q")
        more = left.groupBy("cluster", "block", "chunk").cogroup(right.groupBy("of", "part", "piece")).applyInPandas(_meeting(positives, count), FOUND)
        both = keep(found.unionByName(more), "anchor-found")
        # the best of the few best of each chunk
        order = F.struct((-F.col("score")).alias("s"), "id", "row")
        top = both.groupBy("anchor", "slot").agg(F.slice(F.array_sort(F.collect_list(order)), 1, count).alias("top"))
        top = top.select("anchor", "slot", F.explode("top").alias("t"))
        found = keep(top.select("anchor", "slot", F.col("t.row").alias("row"), F.col("t.id").alias("id"), (-F.col("t.s")).alias("score")), "anchor-best")
    return found


def _meeting(positives: bool, count: int):
    def run(walkers: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({name: pd.Series(dtype=np.int64) for name in ("anchor", "slot", "row", "id", "score")})
        if walkers.empty or rows.empty:
            return empty
        rows = rows.sort_values(["id", "row"])
        row, ids, labels = (rows[name].to_numpy() for name in ("row", "id", "label"))
        scores = products(np.stack(walkers["q"].to_list()), np.stack(rows["q"].to_list()))
        anchor = walkers["anchor"].to_numpy()
        same = walkers["label"].to_numpy()[:, None] == labels[None, :]
        allowed = same & (anchor[:, None] != row[None, :]) if positives else ~same
        lines = [(i, g) for i, goals in enumerate(walkers["goals"]) for g in goals]
        line = np.array([i for i, _ in lines])
        slot = np.array([g["slot"] for _, g in lines])
        # a goal that has enough takes nothing below its last row
        low = np.array([max(g["low"], g["low"] if g["last"] is None else g["last"]) for _, g in lines], dtype=np.int64)
        high = np.array([g["high"] for _, g in lines], dtype=np.int64)
        parts = []
        for k in np.unique(slot):  # one goal of each member at a time
            some = np.flatnonzero(slot == k)
            at = line[some]
            fit = allowed[at] & (scores[at] >= low[some, None]) & (scores[at] <= high[some, None])
            i, j = best(scores[at], fit, count)
            parts.append(pd.DataFrame({"anchor": anchor[at[i]], "slot": slot[some[i]], "row": row[j], "id": ids[j], "score": scores[at[i], j]}))
        return pd.concat(parts) if parts else empty

    return run


def mine(
    df: DataFrame,
    id_col: str,
    vector: Column,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    clusters: int = CLUSTERS,
    slices: tuple[float, ...] = SLICES,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vector` holds integers (see `integer_vector`). Positives are the anchor's highest-scoring other
    rows of its label; the negatives of a positive are the highest-scoring rows of other
    labels with 80 * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    rows = valid_rows(df, id_col, vector, label, is_anchor)
    sample = rows.where("anchor").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("q").collect()
    centres = Centres([np.array(r.q, dtype=np.float64) for r in sample], clusters)
    members = keep(assigned(rows, centres, block), "anchor-members")
    lists = shared_lists(rows, centres, members, slices, chunk)
    lowest, highest = -(1 << 63), (1 << 63) - 1
    goals = members.select("anchor", F.lit(0).alias("slot"), F.lit(lowest).alias("low"), F.lit(highest).alias("high"))
    chosen = walk(members, lists, goals, True, len(slices), positives)
    chosen = chosen.groupBy("anchor").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "row")).alias("all"))
    chosen = chosen.select("anchor", F.posexplode(F.array_sort("all")).alias("slot", "p"))
    chosen = keep(chosen.select("anchor", "slot", F.col("p.id").alias("positive_id"), (-F.col("p.s")).alias("positive_score")), "anchor-positives")
    score = F.col("positive_score")
    windows = chosen.where(score >= 0).select("anchor", "slot", F.expr("(4 * positive_score + 4) div 5").alias("low"), score.alias("high"))
    found = walk(members, lists, windows, False, len(slices), negatives)
    found = found.groupBy("anchor", "slot").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "row"))).alias("all"))
    found = found.select("anchor", "slot", F.posexplode("all").alias("rank", "n"))
    result = found.join(chosen, ["anchor", "slot"]).join(members.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return result.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", (-F.col("n.s")).alias("negative_score"),
    )


MINE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE label <> positives.anchor_label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
