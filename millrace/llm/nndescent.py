"""Nearest neighbours by inner product: a neighbour graph from NN-descent, searched greedily.

Equal vectors form one node; its smallest ids stand for it, so that copies cost nothing
and ties go to smaller ids. First lists come from random-projection blocks of bounded
size. Each round of NN-descent then joins every node's neighbours, and a bounded number
of nodes that point to it, with one another, and keeps each node's nearest. Nodes are
grouped by the leaf they fall into, so that a vector travels once per leaf and not once
per pair. Rounds compare vectors of one byte per component; the result is
measured anew on the original vectors in double precision.

A query is a row of the table. Its search starts from its own node and expands the best
unexpanded nodes of a list of bounded length for a few rounds, all queries together.

The projection trees are fitted on at most SAMPLE vectors; every vector is indexed.

Rules for unusual rows: rows whose id is null, whose vector is null, empty, zero, or
holds null or non-finite components take no part, nor do vectors of another length than
the most frequent one (of equally frequent ones the longer). Rows with equal id and
vector count once; a query never returns its own id. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep

SAMPLE = 8192  # vectors the projection trees are fitted on
TREES = 4
LEAF = 700  # nodes of a leaf, on average; two neighbouring leaves are a block of the first comparison
BLOCK = 3000  # nodes compared with one another at most, about
DEEPEST = 9  # levels of a tree; larger leaves are split by a hash


@dataclass(frozen=True)
class Settings:
    neighbours: int = 48  # kept per node
    reverse: int = 32  # nodes that point to a node and take part in its join
    rounds: int = 3
    width: int = 128  # length of a query's list
    expand: int = 32  # nodes expanded per query and round
    steps: int = 4
    seed: int = 7


def nodes(vectors: DataFrame, id_column: str, vector_column: str, at_most: int) -> DataFrame:
    """(id, vec, members): one row per different vector; id is its smallest id, members its `at_most` smallest ones."""
    vec = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("member"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    some = F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("member").isNotNull() & F.col("vec").isNotNull() & finite & some)
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    rows = rows.where(F.size("vec") == (sizes.dim if sizes else 0))
    # the limit per vector is applied before the shuffle as well, so many copies stay few rows
    order = F.dense_rank().over(Window.partitionBy("vec").orderBy("member"))
    first = rows.withColumn("place", order).where(F.col("place") <= at_most)
    members = first.groupBy("vec").agg(F.sort_array(F.collect_set("member")).alias("members"))
    return members.select(F.col("members")[0].alias("id"), "vec", "members")


@dataclass
class Tree:
    """Hyperplanes and thresholds by node, root first; children of i are 2 i + 1 and 2 i + 2."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (np.einsum("ij,ij->i", x, self.planes[at]) > self.cuts[at])
        return at - (2**self.depth - 1)


def plant(sample: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
    """A tree whose cuts are the sample's medians along random directions."""
    inner = 2**depth - 1
    planes, cuts = rng.standard_normal((max(inner, 1), sample.shape[1])), np.zeros(max(inner, 1))
    at = np.zeros(len(sample), dtype=np.int64)
    for node in range(inner):
        mine = at == node
        if mine.any():
            along = sample[mine] @ planes[node]
            cuts[node] = np.median(along)
            at[mine] = 2 * node + 1 + (along > cuts[node])
    return Tree(planes, cuts, depth)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per component, and the scale of each vector."""
    scale = np.abs(x).max(axis=1) / 127
    return np.round(x / scale[:, None]).astype(np.int8), scale


def unquantised(data: pd.Series, scale: pd.Series) -> np.ndarray:
    if not len(data):
        return np.zeros((0, 1), dtype=np.float32)
    q = np.frombuffer(b"".join(data), dtype=np.int8).reshape(len(data), -1)
    return q.astype(np.float32) * scale.to_numpy(dtype=np.float32)[:, None]


def placed(found: DataFrame, seed: int) -> DataFrame:
    """Nodes with their short vector (q, scale), a block per tree, and the home their joins run in: their leaf of the first tree."""
    total = found.count()
    sample = found.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    x = np.array([r.vec for r in sample])
    depth = int(np.clip(np.round(np.log2(max(total, 1) / LEAF)), 0, DEEPEST))
    rng = np.random.default_rng(seed)
    trees = [plant(x, depth, rng) for _ in range(TREES)] if len(x) else []

    @F.pandas_udf("q binary, scale double, leaves array<int>")
    def place(vecs: pd.Series) -> pd.DataFrame:
        v = np.stack(vecs)
        q, scale = quantised(v)
        leaves = np.stack([t.leaves(v) for t in trees], axis=1)
        return pd.DataFrame({"q": [r.tobytes() for r in q], "scale": scale, "leaves": list(leaves.astype(np.int32))})

    marked = keep(found.select("*", place("vec").alias("p")).select("id", "vec", "members", "p.*"), "nn-placed")
    # TREES x 2 ** DEEPEST rows at most
    sizes = marked.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    homes, blocks = Counter(), Counter()
    for r in sizes:
        blocks[r.tree, r.leaf >> 1] += r["count"]
        if r.tree == 0:
            homes[0, r.leaf] = r["count"]

    def group(tree: int, number: Column, counts: Counter) -> Column:
        """The group's number; what the tree leaves too large is split by a hash."""
        splits = F.array(*[F.lit(-(-counts[tree, i] // BLOCK) or 1) for i in range(2**depth)])
        split = F.pmod(F.xxhash64("id", F.lit(tree)), F.get(splits, number).cast("long"))
        return number.cast("long") * (1 << 32) + split

    columns = [group(t, F.shiftright(F.col("leaves")[t], 1), blocks).alias(f"b{t}") for t in range(TREES)]
    home = group(0, F.col("leaves")[0], homes).alias("home")
    return keep(marked.select("id", "vec", "members", "q", "scale", home, *columns), "nn-nodes")


def nearest(u: np.ndarray, w: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of triples (u, w, s): the k largest s of each u, every w once, ties to smaller w."""
    order = np.lexsort((w, u))
    u, w, s = u[order], w[order], s[order]
    fresh = np.ones(len(u), dtype=bool)
    fresh[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, s = u[fresh], w[fresh], s[fresh]
    order = np.lexsort((w, -s, u))
    u, w, s = u[order], w[order], s[order]
    kept = np.arange(len(u)) - np.searchsorted(u, u) < k
    return u[kept], w[kept], s[kept]


def first_lists(index: DataFrame, k: int) -> DataFrame:
    """(id, nbr, s): nearest nodes within each block of each tree."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = unquantised(pdf["q"], pdf["scale"]), pdf["id"].to_numpy()
        n, parts = min(k, len(ids) - 1), []
        for i in range(0, len(ids) if n else 0, 1024):
            s = x[i : i + 1024] @ x.T
            s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            parts.append((np.repeat(ids[i : i + 1024], n), ids[top].ravel(), np.take_along_axis(s, top, axis=1).ravel()))
        u, w, s = (np.concatenate([p[j] for p in parts]) if parts else np.zeros(0) for j in range(3))
        return pd.DataFrame({"id": u.astype(np.int64), "nbr": w.astype(np.int64), "s": s})

    blocks = F.posexplode(F.array(*[F.col(f"b{t}") for t in range(TREES)])).alias("tree", "block")
    return index.select("id", "q", "scale", blocks).groupBy("tree", "block").applyInPandas(compare, "id long, nbr long, s float")


def merged(parts: DataFrame, homes: DataFrame, k: int) -> DataFrame:
    """(id, home, nbr, s): the k nearest of each node from parts (id, nbr, s)."""

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        u, w, s = nearest(pdf["id"].to_numpy(), pdf["nbr"].to_numpy(), pdf["s"].to_numpy(), k)
        return pd.DataFrame({"id": u, "home": pdf["home"].iloc[0] if len(pdf) else 0, "nbr": w, "s": s})

    return parts.join(homes, "id").groupBy("home").applyInPandas(best, "id long, home long, nbr long, s float")


def reverse_edges(graph: DataFrame, homes: DataFrame, at_most: int, seed: int) -> DataFrame:
    """(v, home, u): at most `at_most` nodes u that have v as a neighbour, chosen by a hash."""
    turned = graph.select(F.col("nbr").alias("v"), F.col("id").alias("u"))
    order = Window.partitionBy("v").orderBy(F.xxhash64("u", "v", F.lit(seed)), "u")
    some = turned.withColumn("place", F.row_number().over(order)).where(F.col("place") <= at_most).drop("place")
    return some.join(homes.withColumnRenamed("id", "v"), "v").select("v", "home", "u")


def improve(graph: DataFrame, index: DataFrame, homes: DataFrame, settings: Settings, turn: int) -> DataFrame:
    """One round: the neighbours of each node, both ways, are compared with one another."""
    k = settings.neighbours
    edges = graph.select(F.col("id").alias("v"), "home", F.col("nbr").alias("u"))
    edges = edges.union(reverse_edges(graph, homes, settings.reverse, settings.seed + turn))
    edges = edges.union(homes.select(F.col("id").alias("v"), "home", F.col("id").alias("u")))
    edges = keep(edges, "nn-edges")
    # the score a newcomer must beat
    least = graph.groupBy("id").agg(F.min("s").alias("least"), F.count("*").alias("n"))
    least = least.select("id", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf")).cast("float").alias("least"))
    needed = edges.select(F.col("home").alias("at"), F.col("u").alias("id")).distinct().join(index.select("id", "q", "scale").join(least, "id", "left"), "id")

    def join(edges: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(members["id"].to_numpy())
        ids = members["id"].to_numpy()[order]
        x = unquantised(members["q"], members["scale"])[order]
        bar = members["least"].fillna(-np.inf).to_numpy(dtype=np.float32)[order]
        edges = edges.sort_values("v")
        v, u = edges["v"].to_numpy(), np.searchsorted(ids, edges["u"].to_numpy())
        cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1), len(v)]
        found, held, best = [], 0, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        for a, b in zip(cuts, cuts[1:], strict=False):
            group = np.unique(u[a:b])
            s = x[group] @ x[group].T
            np.fill_diagonal(s, -np.inf)
            i, j = np.nonzero(s > bar[group][:, None])
            found.append((group[i], group[j], s[i, j]))
            held += len(i)
            if held > 500_000 or b == len(v):  # what a task sends is at most k per node
                best = nearest(*(np.concatenate([best[n], *[f[n] for f in found]]) for n in range(3)), k)
                found, held = [], 0
        return pd.DataFrame({"id": ids[best[0]], "nbr": ids[best[1]], "s": best[2]})

    pairs = edges.groupBy("home").cogroup(needed.groupBy("at")).applyInPandas(join, "id long, nbr long, s float")
    return keep(merged(graph.select("id", "nbr", "s").union(pairs), homes, k), "nn-graph")


def build(index: DataFrame, settings: Settings) -> DataFrame:
    """The neighbour graph (id, home, nbr, s)."""
    homes = index.select("id", "home")
    graph = keep(merged(first_lists(index, settings.neighbours), homes, settings.neighbours), "nn-graph")
    for turn in range(settings.rounds):
        graph = improve(graph, index, homes, settings, turn)
    return graph


STATE = "qid long, home long, vec array<double>, ids array<long>, scores array<float>, done array<boolean>"


def search(queries: DataFrame, index: DataFrame, graph: DataFrame, settings: Settings) -> DataFrame:
    """Greedy search for each row (qid, home, vec) of queries, which are nodes: their lists (STATE) after all steps."""
    homes = index.select("id", "home")
    both = graph.select("id", "nbr").union(
        reverse_edges(graph, homes, settings.reverse, settings.seed).select(F.col("v").alias("id"), F.col("u").alias("nbr"))
    )
    ways = keep(both.groupBy("id").agg(F.collect_set("nbr").alias("nbrs")), "nn-ways")  # neighbours + reverse at most
    state = queries.select("qid", "home", "vec", F.array("qid").alias("ids"))
    state = state.withColumn("scores", F.array(F.lit(0).cast("float"))).withColumn("done", F.array(F.lit(False)))
    width, expand = settings.width, settings.expand

    def step(state: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        lists = fetched[fetched["nbrs"].notna()]
        near = dict(zip(lists["id"], lists["nbrs"], strict=True))
        vectors = fetched[fetched["q"].notna()].sort_values("id")
        known, x = vectors["id"].to_numpy(), unquantised(vectors["q"], vectors["scale"])
        rows = []
        for r in state.itertuples(index=False):
            ids, done = np.asarray(r.ids), np.asarray(r.done, dtype=bool)
            now = np.flatnonzero(~done)[:expand]
            new = np.concatenate([np.zeros(0, np.int64), *(near[i] for i in ids[now] if i in near)])
            new = np.setdiff1d(new, ids)
            done[now] = True
            s = x[np.searchsorted(known, new)] @ np.asarray(r.vec, dtype=np.float32) if len(new) else np.zeros(0, np.float32)
            ids, scores = np.concatenate([ids, new]), np.concatenate([np.asarray(r.scores, dtype=np.float32), s])
            done = np.concatenate([done, np.zeros(len(new), dtype=bool)])
            top = np.lexsort((ids, -scores))[:width]
            rows.append((r.qid, r.home, r.vec, ids[top], scores[top], done[top]))
        return pd.DataFrame(rows, columns=["qid", "home", "vec", "ids", "scores", "done"])

    for _ in range(settings.steps):
        state = keep(state, "nn-state")
        # the list is in order: the first `expand` that are not done are next
        waiting = F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"])
        nexts = state.select("home", F.explode(F.slice(waiting, 1, expand)).alias("e")).select("home", F.col("e.ids").alias("id")).distinct()
        lists = keep(nexts.join(ways, "id"), "nn-lists").select("home", "id", "nbrs")
        wanted = lists.select("home", F.explode("nbrs").alias("id")).distinct().join(index.select("id", "q", "scale"), "id")
        fetched = lists.select(F.col("home").alias("at"), "id", "nbrs", F.lit(None).cast("binary").alias("q"), F.lit(None).cast("double").alias("scale"))
        fetched = fetched.union(wanted.select("home", "id", F.lit(None).cast("array<long>").alias("nbrs"), "q", "scale"))
        state = state.groupBy("home").cogroup(fetched.groupBy("at")).applyInPandas(step, STATE)
    return keep(state, "nn-state")


def neighbours(
    vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 20, settings: Settings | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row where `is_query` holds."""
    settings = settings or Settings()
    found = keep(nodes(vectors, id_column, vector_column, k + 1), "nn-distinct")
    empty = "query_id long, rank int, vec_id long, score double"
    if found.isEmpty():
        return vectors.sparkSession.createDataFrame([], empty)
    index = placed(found, settings.seed)
    # query rows with their node; the node of a vector is found by the vector itself
    asked = vectors.where(is_query).select(F.col(f"`{id_column}`").cast("long").alias("query_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vec"))
    asked = asked.where(F.col("query_id").isNotNull()).distinct().join(index.select("vec", F.col("id").alias("qid")), "vec").select("query_id", "qid")
    asked = keep(asked, "nn-asked")
    starts = index.join(asked.select(F.col("qid").alias("id")).distinct(), "id", "left_semi")
    starts = starts.select(F.col("id").alias("qid"), "home", "vec")
    state = search(starts, index, build(index, settings), settings)

    # exact scores of the best of each list, on the original vectors; the node itself may hold other rows
    short = state.select("qid", "home", F.explode(F.slice("ids", 1, 3 * k)).alias("id"))
    short = short.union(state.select("qid", "home", F.col("qid").alias("id"))).distinct()
    originals = short.select(F.col("home").alias("at"), "id").distinct().join(index.select("id", "vec", "members"), "id")

    def measure(state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        known, members = rows["id"].to_numpy(), list(rows["members"])
        x = np.stack(rows["vec"]) if len(rows) else np.zeros((0, 1))
        out = []
        for r in state.itertuples(index=False):
            at = np.searchsorted(known, np.unique([*r.ids[: 3 * k], r.qid]))
            score = x[at] @ np.asarray(r.vec)
            every = np.concatenate([members[i] for i in at])
            values = np.repeat(score, [len(members[i]) for i in at])
            best = np.lexsort((every, -values))[: k + 1]
            out.append((r.qid, every[best], values[best]))
        return pd.DataFrame(out, columns=["qid", "ids", "scores"])

    lists = state.groupBy("home").cogroup(originals.groupBy("at")).applyInPandas(measure, "qid long, ids array<long>, scores array<double>")
    # k + 1 entries per node; a query drops its own id and keeps k
    pairs = asked.join(keep(lists, "nn-found"), "qid").select("query_id", F.arrays_zip("ids", "scores").alias("e"))
    others = F.filter("e", lambda x: x["ids"] != F.col("query_id"))
    ranked = pairs.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "e"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score"))
