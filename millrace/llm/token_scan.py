"""Token counts per document of flat token files that have no index.

A file is one stream of ids; an end-of-document id closes each document. Blocks of
such files are scanned independently, in any order: a vectorised search gives the
places of the separators. Documents that cross blocks are put together from what each
block says about itself - tokens, separators, the last separator's place - by a prefix
scan in two levels: over runs of RUN blocks, and over the blocks inside a run. So a
single huge file is no single group.

Rules for unusual input: an empty block changes nothing; tokens after the last
separator are a document with closed = false; two separators in a row close an empty
document (only its separator is counted); blocks must be numbered in order, gaps in the
numbers do not matter. For documents: null texts count as empty, null ids are
kept, repeated rows are counted each, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder, vocabulary
from millrace.llm.common import keep

BLOCK_TOKENS = 1 << 18
RUN = 1024  # blocks of a run
BATCH = 512  # documents encoded at a time
WIDTH = {"<u2": 2, "<u4": 4}


def write_stream(docs: DataFrame, end_id: int = 50256, dtype: str = "<u2", tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Encodes documents into one stream per task, cut into blocks wherever they are full.

    Returns blocks (file, block, payload) and the order of the documents
    (file, ordinal, doc_id). Inside a text the separator's id can only come from the
    tokenizer's own end mark written out; it is left out, or it would close a document.
    """
    path = tokenizer or vocabulary()

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, file = encoder(path).encode, TaskContext.get().partitionId()
        end, size = np.array([end_id], dtype=dtype).tobytes(), BLOCK_TOKENS * WIDTH[dtype]
        left, block, ordinal = b"", 0, 0
        for pdf in pdfs:
            for i in range(0, len(pdf), BATCH):
                part = pdf.iloc[i : i + BATCH]
                pieces, ids = [left], []
                for doc_id, one in zip(part["doc_id"], encode(list(part["text"])), strict=True):
                    tokens = np.frombuffer(one, dtype="<u4")
                    pieces += [tokens[tokens != end_id].astype(dtype).tobytes(), end]
                    ids.append((file, ordinal, int(doc_id) if doc_id else None))
                    ordinal += 1
                left = b"".join(pieces)
                rows = []
                while len(left) >= size:
                    rows.append((file, block, left[:size]))
                    left, block = left[size:], block + 1
                yield _rows(rows, ids)
        if left:
            yield _rows([(file, block, left)], [])

    picked = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string"))
    both = keep(picked.mapInPandas(run, "file long, block long, payload binary, ordinal long, doc_id long"), "token-stream")
    return (
        both.where("payload is not null").select("file", "block", "payload"),
        both.where("ordinal is not null").select("file", "ordinal", "doc_id"),
    )


def _rows(blocks: list[tuple], ids: list[tuple]) -> pd.DataFrame:
    rows = [(f, b, p, None, None) for f, b, p in blocks] + [(f, None, None, o, d) for f, o, d in ids]
    out = pd.DataFrame(rows, columns=["file", "block", "payload", "ordinal", "doc_id"])
    return out.astype({"file": "Int64", "block": "Int64", "ordinal": "Int64", "doc_id": "Int64"})


def read_token_files(spark: SparkSession, path: str, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, payload) of flat files; a file may have up to 2 GB, Spark's limit for one value."""
    size = block_tokens * WIDTH[dtype]
    content = F.col("content")
    numbers = F.sequence(F.lit(0).cast("long"), F.greatest((F.col("length") - 1).cast("long"), F.lit(0).cast("long")), F.lit(size).cast("long"))
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    cut = files.select(F.col("path").alias("file"), "content", F.explode(numbers).alias("at"))
    payload = F.substring(content, (F.col("at") + 1).cast("int"), F.lit(size))
    return cut.select("file", (F.col("at") / size).cast("long").alias("block"), payload.alias("payload"))


def separators(blocks: DataFrame, end_id: int, dtype: str) -> DataFrame:
    """(file, block, tokens, ends): the places of the separators in each block, by one vectorised search."""

    @F.pandas_udf("tokens long, ends array<int>")
    def search(payloads: pd.Series) -> pd.DataFrame:
        streams = [np.frombuffer(p, dtype=dtype) for p in payloads]
        return pd.DataFrame({"tokens": [len(s) for s in streams], "ends": [np.flatnonzero(s == end_id).astype(np.int32) for s in streams]})

    return blocks.where("payload is not null").select("file", "block", search("payload").alias("s")).select("file", "block", "s.*")


def documents(blocks: DataFrame, end_id: int = 50256, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, start, tokens, closed): every document of every file; tokens without the separator."""
    found = keep(separators(blocks, end_id, dtype), "token-ends").withColumn("run", F.floor(F.col("block") / RUN))
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    seps = F.size("ends").cast("long")
    found = found.withColumn("at", F.coalesce(F.sum("tokens").over(inside), zero)).withColumn("before", F.coalesce(F.sum(seps).over(inside), zero))
    last = F.when(seps > 0, F.col("at") + F.get("ends", F.size("ends") - 1))  # place of the block's last separator in its run
    found = found.withColumn("last", last)
    found = found.withColumn("prior", F.max("last").over(inside))
    # one row per run; their scan gives each run the tokens, separators and last separator before it
    runs = found.groupBy("file", "run").agg(F.sum("tokens").alias("tokens"), F.sum(seps).alias("seps"), F.max("last").alias("last"))
    over = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_at", F.coalesce(F.sum("tokens").over(over), zero))
    runs = runs.withColumn("run_before", F.coalesce(F.sum("seps").over(over), zero))
    runs = runs.withColumn("run_prior", F.max(F.col("run_at") + F.col("last")).over(over))
    place = runs.select("file", "run", "run_at", "run_before", "run_prior")
    rows = found.join(place, ["file", "run"])
    at = F.col("run_at") + F.col("at")
    # first token of the document that is open where the block begins
    opened = F.coalesce(F.col("run_at") + F.col("prior"), F.col("run_prior"), F.lit(-1).cast("long")) + 1
    rows = rows.select("file", at.alias("at"), opened.alias("opened"), (F.col("run_before") + F.col("before")).alias("before"), "ends")
    closed = rows.select("file", "at", "opened", "before", F.col("ends"), F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("opened")).otherwise(F.col("at") + F.get("ends", F.col("i") - 1) + 1)
    closed = closed.select("file", (F.col("before") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("at") + F.col("end") - start).alias("tokens"))
    totals = runs.groupBy("file").agg(
        F.sum("tokens").alias("all"), F.sum("seps").alias("ordinal"), (F.coalesce(F.max(F.col("run_at") + F.col("last")), F.lit(-1)) + 1).alias("start")
    )
    tail = totals.where("all > start").select("file", "ordinal", "start", (F.col("all") - F.col("start")).alias("tokens"))
    return closed.withColumn("closed", F.lit(True)).union(tail.withColumn("closed", F.lit(False)))


def count_tokens(docs: DataFrame, end_id: int = 50256, dtype: str = "<u2") -> DataFrame:
    """(doc_id, file, ordinal, start, tokens): documents encoded into flat streams, and counted from the streams alone."""
    blocks, order = write_stream(docs, end_id, dtype)
    return documents(blocks, end_id, dtype).where("closed").join(order, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "tokens")
