"""Helpers that several operators of this package use."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stored, workspace

BITS = 1 << 26  # of the filters before shuffles


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


_swept: list[list[str]] = []


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write df to a fresh shared folder and read it back: cuts the lineage and survives lost executors.

    The folder stays for as long as a result may read it; `swept` removes it.
    """
    return stored(df, kept_folder(df.sparkSession, label))


def kept_folder(spark: SparkSession, label: str) -> str:
    """A fresh shared folder that goes when `swept` says so."""
    path = workspace(spark, label)
    if _swept:
        _swept[-1].append(path)
    return path


@contextlib.contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Removes, on success, the folders that `keep` made inside the block; results must be written by then."""
    _swept.append([])
    try:
        yield
    finally:
        made = _swept.pop()
    for folder in made:
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def filter_of(df: DataFrame, key: str) -> Column:
    """A test on a long column that holds for all values of df's: a bitmap of fixed size, whatever the number of values."""
    place = F.pmod(F.col(key), F.lit(BITS))
    size = 1 << 15
    parts = df.select(place.alias("p")).groupBy(F.expr(f"p div {size}").alias("part")).agg(F.bitmap_construct_agg(F.col("p") % size).alias("bits"))
    bits = np.zeros((BITS // size, size // 8), dtype=np.uint8)
    for part in parts.collect():
        bits[part["part"]] = np.frombuffer(part["bits"], dtype=np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bits.ravel())

    @F.pandas_udf(T.BooleanType())
    def test(values: pd.Series) -> pd.Series:
        at = values.to_numpy() % BITS
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return test(F.col(key))


_cache: dict[tuple, object] = {}


def worker_cache(key: tuple, build):
    """What `build` gives, kept in the worker process for later tasks; only the last one asked for is kept.

    Workers outlive stages, so the caches of several operators would add up.
    """
    if key not in _cache:
        _cache.clear()
        _cache[key] = build()
    return _cache[key]


def fold_zero(doc_id: Column, folds: int) -> Column:
    """True where crc32 of the id's digits leaves no remainder; a null id counts as an empty text (crc32 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; other letters stay as they are. A null text has none."""
    return text.encode().lower().split() if text else []


def connected_components(edges: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """(node, component) for every node of an undirected graph; the component is its smallest node.

    Alternating large and small stars: every round hangs the larger neighbours,
    then the smaller ones, on the smallest one known. Each round is written to the
    shared folder, so that plans stay short and a lost executor costs one round.
    No list of neighbours is ever gathered; minima combine before the shuffle.
    Null ends and self links are dropped (a node without links is not in the result).
    """
    x, y = F.col(a), F.col(b)
    links = edges.where(x.isNotNull() & y.isNotNull() & (x != y))
    links = keep(links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), label)
    seen = None
    while True:
        stars = _star(_star(links, larger=True), larger=False)
        links = keep(stars, label)
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """links (u > v): hang the larger (or the smaller) neighbours of each node on its smallest neighbour."""
    if larger:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()
