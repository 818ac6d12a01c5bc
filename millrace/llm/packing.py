"""Packing documents into windows of tokens by the sum-of-squares rule.

A document's ids, closed by an end id, are cut into full windows; what is left
over goes online, one document after the other, to the fill level that makes the
sum of squared counts of partially filled windows smallest. The counts are kept in
an array by level. A task packs what it reads: nothing is shuffled, the state is
one array and the open windows, and a repeated task packs the same rows again.

At the end of a task the windows still open are filled by cutting their contents
anew, and the rest is closed as windows whose lengths are powers of two, so no
window needs padding.

Rules for unusual rows: a null text counts as empty (its end id is still packed); a
null doc_id is kept; repeated rows are packed once each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder, vocabulary

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = [field.split()[0] for field in SCHEMA.split(", ")]
BATCH = 512  # documents encoded at a time

# a piece: doc_id, first token, ids as bytes, tokens of the document
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Windows of one task. `level[h]` counts the open windows that hold h tokens."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.level = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            self._close([(doc_id, start, ids[4 * start : 4 * (start + self.capacity)], total)])
            start += self.capacity
        if start < total:
            self._place((doc_id, start, ids[4 * start :], total))

    def _place(self, piece: Piece) -> None:
        size = len(piece[2]) // 4
        old = self._best(size)
        window = self.open[old].pop() if old else []
        if old:
            self.level[old] -= 1
        window.append(piece)
        if old + size == self.capacity:
            self._close(window)
        else:
            self.level[old + size] += 1
            self.open[old + size].append(window)

    def _best(self, size: int) -> int:
        """Level whose window the piece joins; 0 opens a new one.

        Moving a window from h to h + size changes the sum of squares by
        2 (level[h + size] - level[h]) + 2; empty and full windows are not counted.
        Of equal changes the fullest window wins.
        """
        top = self.capacity - size
        change = 2 * (self.level[size : self.capacity + 1] - self.level[: top + 1]) + 2
        change[0] = 2 * self.level[size] + 1
        change[top] = 1 - 2 * self.level[top]
        allowed = self.level[: top + 1] > 0
        allowed[0] = True
        change = np.where(allowed, change, np.iinfo(np.int64).max)
        return int(top - np.argmin(change[::-1]))

    def _close(self, window: list[Piece]) -> None:
        offset = 0
        for doc_id, start, ids, total in window:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), total, self.sequence, offset))
            offset += length
        self.sequence += 1

    def finish(self) -> None:
        """Cut the contents of the open windows into full ones, the rest into powers of two."""
        left = [piece for windows in reversed(self.open) for window in windows for piece in window]
        tokens = sum(len(piece[2]) // 4 for piece in left)
        sizes = [self.capacity] * (tokens // self.capacity)
        rest = tokens % self.capacity
        sizes += [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
        left.reverse()
        for size in sizes:
            window, room = [], size
            while room:
                doc_id, start, ids, total = left.pop()
                taken = min(room, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * taken], total))
                if 4 * taken < len(ids):
                    left.append((doc_id, start + taken, ids[4 * taken :], total))
                room -= taken
            self._close(window)
        self.open, self.level = [[] for _ in range(self.capacity + 1)], np.zeros_like(self.level)

    def take(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        return pd.DataFrame(rows, columns=COLUMNS).astype({"doc_id": "Int64"})


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: which ids of which document stand where in which window.

    `sequence_id` is unique: the task's partition number in the upper bits, a
    counter below. `ids_crc32` is taken over little-endian unsigned 32-bit ids.
    """
    path = tokenizer or vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        packer = Packer(capacity, TaskContext.get().partitionId() << 36)
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                part = batch.iloc[i : i + BATCH]
                for doc_id, ids in zip(part["doc_id"], encode(list(part["text"])), strict=True):
                    packer.add(int(doc_id) if doc_id else None, ids + end)
                yield packer.take()
        packer.finish()
        yield packer.take()

    # the id travels as text: pandas would turn longs beside a null into doubles
    picked = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string"))
    return picked.mapInPandas(run, SCHEMA)
