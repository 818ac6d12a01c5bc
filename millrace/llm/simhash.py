"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, checked Hamming distance.

Rules for unusual rows: a null text counts as empty; a text without words has
fingerprint zero and links like any other; shorter texts than a shingle are one
shingle. Repeated rows stay, one result row each. A null id never becomes a
component's id unless all ids of the component are null. Other columns are ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import connected_components, keep, words_of

BITS = 64
SLAB = 1 << 16  # shingles hashed at a time, so that a very long text needs little memory
MAX_DIFFERING = 3
TOGETHER = 20_000  # rows of small blocks linked in one call
DENSE = 2048  # distinct fingerprints above which a block is split again


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set where it is set in more than half of the XXH64 hashes (seed 42) of the shingles."""
    words = words_of(text)
    if not words:
        return 0
    n = min(shingle, len(words))
    grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(n)), strict=False))
    hashes = map(partial(xxhash.xxh64_intdigest, seed=42), grams)
    votes, total = np.zeros(BITS, dtype=np.int64), 0
    while len(slab := np.fromiter(islice(hashes, SLAB), dtype="<u8")):
        votes += np.unpackbits(slab.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(slab)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The 64 bits as a long. Only the text travels to Python, in Arrow batches."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return run(text.cast("string"))


def split_bits(first: int, width: int, parts: int) -> list[tuple[int, int]]:
    """(offset, width) of nearly equal neighbouring blocks."""
    cuts = [first + width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(blocks: list[tuple[int, int]], different: int) -> list[int]:
    """One mask per choice of the blocks that stay equal when `different` blocks may differ."""
    ones = [((1 << width) - 1) << offset for offset, width in blocks]
    return [sum(choice) for choice in combinations(ones, len(ones) - different)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _keys(fp: Column, chosen: list[int]) -> Column:
    """Array of (table, key): the fingerprint's bits under each mask."""
    return F.array(
        *[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key")) for i, m in enumerate(chosen)]
    )


def near_components(fps: np.ndarray, most: int = MAX_DIFFERING) -> np.ndarray:
    """For distinct fingerprints: the smallest one that each is linked to, directly or through others.

    Breadth first over those not reached yet; a reached one is never compared again
    with others reached before, so a dense family costs far less than all its pairs.
    """
    order = np.sort(fps)
    out = np.empty_like(order)
    left, where = order.view(np.uint64), np.arange(len(order))
    while len(left):
        root, todo = order[where[0]], [left[0]]
        out[where[0]] = root
        left, where = left[1:], where[1:]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= most
            if near.any():
                todo.extend(left[near])
                out[where[near]] = root
                left, where = left[~near], where[~near]
    return np.stack([order, out])


def _link(pdf: pd.DataFrame) -> pd.DataFrame:
    """Star links of every group (outer, t, key) in the frame."""
    pdf = pdf.sort_values(["outer", "t", "key"])
    group = pdf[["outer", "t", "key"]].to_numpy()
    cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1), len(pdf)]
    fps, found = pdf["fp"].to_numpy(dtype=np.int64), []
    for a, b in zip(cuts, cuts[1:], strict=False):
        pairs = near_components(fps[a:b])
        found.append(pairs[:, pairs[0] != pairs[1]])
    node, root = np.concatenate(found, axis=1)
    return pd.DataFrame({"a": node, "b": root})


def _linked(rows: DataFrame) -> DataFrame:
    """Links inside the groups (outer, t, key); several groups share a call, about `TOGETHER` rows of them."""
    rows = keep(rows, "simhash-groups")
    calls = max(1, rows.count() // TOGETHER)
    call = F.pmod(F.xxhash64("outer", "t", "key"), F.lit(calls))
    return rows.groupBy(call.alias("call")).applyInPandas(_link, "a long, b long")


def near_links(distinct: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints (column fp) within three bits.

    Six blocks of bits: three differing bits leave three blocks equal, so every
    close pair shares the key of one of twenty tables. Inside a key the distance
    is checked, and each fingerprint is tied to the smallest one it reaches: as many
    rows as fingerprints, never all pairs. A key with more than `dense`
    fingerprints is split by the same rule over its 32 free bits: 16 free bits
    remain, so that no group exceeds 65,536 rows, whatever the data.
    """
    blocks = split_bits(0, BITS, 6)
    top = masks(blocks, 3)
    keyed = distinct.select("fp", F.inline(_keys(F.col("fp"), top)))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    sizes = keep(sizes.where("n > 1"), "simhash-sizes")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = sizes.where((F.col("n") == 2) & (differing <= MAX_DIFFERING)).select("a", "b")
    shared = keyed.join(sizes.where("n > 2").select("t", "key", "n"), ["t", "key"])
    shared = keep(shared.withColumn("outer", F.lit(-1)), "simhash-blocks")
    plain = _linked(shared.where(F.col("n") <= dense).select("outer", "t", "key", "fp"))
    # the free blocks of each table, halved; again three of the six stay equal
    finer = []
    for equal in combinations(range(6), 3):
        free = [blocks[i] for i in range(6) if i not in equal]
        halves = [half for offset, width in free for half in split_bits(offset, width, 2)]
        fixed = sum(((1 << width) - 1) << offset for offset, width in (blocks[i] for i in equal))
        finer.append([fixed | m for m in masks(halves, 3)])
    hot = shared.where(F.col("n") > dense)
    by_table = F.element_at(F.array(*[_keys(F.col("fp"), m) for m in finer]), F.col("t") + 1)
    hot = hot.select(F.col("t").alias("outer"), "fp", F.inline(by_table))
    return pairs.union(plain).union(_linked(hot.select("outer", "t", "key", "fp")))


def classes(marked: DataFrame, dense: int = DENSE) -> DataFrame:
    """(fp, first_id, component, component_id) per distinct fingerprint of marked (doc_id, fp)."""
    distinct = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = connected_components(near_links(distinct.select("fp"), dense), "a", "b", "simhash-links")
    placed = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    first = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return placed.join(first, "component")


def near_duplicates(docs: DataFrame, shingle: int = 3, dense: int = DENSE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document, classes by chains of at most three differing bits."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(F.col("text"), shingle).alias("fp"))
    marked = keep(marked, "simhash-prints")
    found = classes(marked, dense).select("fp", "component_id")
    return marked.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, dense: int = DENSE) -> DataFrame:
    """The documents that stay: of each class the row with the smallest id, all columns as they came.

    A row with a null id stays only where no row of its class has an id. Of several
    rows with the kept id one stays, the smallest by all columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    prints = fingerprint_column(F.col("text"), shingle).alias("fp")
    marked = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), prints, row), "simhash-rows")
    return keepers_of(marked, classes(marked.select("doc_id", "fp"), dense))


def keepers_of(marked: DataFrame, found: DataFrame) -> DataFrame:
    """One row of marked (doc_id, fp, row) per component of `found`, as `classes` gives them."""
    found = found.where(F.col("first_id").eqNullSafe(F.col("component_id")))
    keepers = found.groupBy("component", "component_id").agg(F.min("fp").alias("kept_fp"))
    # joined by print and id: a print that many documents share is spread by their ids
    same = (marked["fp"] == keepers["kept_fp"]) & marked["doc_id"].eqNullSafe(keepers["component_id"])
    return marked.join(keepers, same).groupBy("component").agg(F.min("row").alias("row")).select("row.*")
