"""Removal of long repeated strings through a logarithmic family of suffix arrays.

Every MATCH-byte window of a text has one anchor: the position in it whose next CORE bytes hash
lowest. Equal windows have equal anchors, so it is enough to index suffixes that begin at
anchors, about one in 150 bytes. The windows that share an anchor are a run, and the bytes
from the start of its first to the end of its last window are the run's stretch.

A suffix array here is a stored table of those suffixes, dealt out by hash and sorted by their first
bytes and the hash of their cores, one row per different core with its number of copies. A new
batch of texts gets an array of its own. It is merge-scanned against the levels that exist, and
whatever core occurs in both, or twice in the batch, is a candidate for a long match. Levels
hold 1, 2, 4 ... batches; two of one size merge, which is a merge-scan too, so a suffix is
rewritten once for each doubling of the index.

Candidates become exact spans in this way. A stretch that occurs twice is repeated as a whole. Where
stretches differ around an equal core, their windows are compared: the different stretches of a
core meet in one task. Where there are more than DENSE, each is cut into short runs of windows, at
places counted from the anchor, which have longer cores and go the same way again, down to
single windows. Window hashes are compared within equal cores, so equality rests on 128 bits.

Rules for unusual rows: a null text is empty; texts shorter than MATCH bytes lose nothing;
null ids stay; repeated rows are texts each, so all but short ones are removed whole; other
columns are ignored. Long texts are indexed in pieces of PIECE windows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import delete_folder, filter_of, keep
from millrace.session import stored, workspace

MATCH = 400  # bytes
CORE = 112  # bytes
PIECE = 1 << 20  # windows hashed at once
BATCHES = 4  # a whole table is added in so many batches
DENSE = 256  # different stretches of a core that one task compares
TOGETHER = 2048  # stretches in a call, on average
CUTS = (32, 4, 1)  # windows of a run that is cut from a stretch of a dense core, and again
_PLACE = np.uint64((1 << 21) - 1)
_ODD = 0x9E3779B97F4A7C15

RUN = "struct<start:int,windows:int,turn:int,head:long,core:long,hi:long,lo:long,copies:int>"
SPAN = "struct<begin:int,end:int>"
TEXT_KEY = ["ka", "kb"]
STRETCH_KEY = ["core", "hi", "lo"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def string_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The hash of the `width` bytes (8 or more) from each position on that has so many."""
    if len(data) < width:
        return np.zeros(0, dtype=np.uint64)
    h = _mix(np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel())
    size = 8
    while size < width:
        step = min(size, width - size)  # the two halves may overlap
        h = h[:-step] * np.uint64(pow(_ODD, step, 1 << 64)) + h[step:]
        size += step
    return _mix(h)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: len(values) - width + 1], forward[width - 1 : len(values)])


def runs_of(text: bytes) -> dict[str, np.ndarray]:
    """The runs of a text in order: start, number of windows, place of the anchor from there, first bytes and hash of the core, hash of the stretch."""
    found: dict[str, list] = {name: [] for name in ("start", "windows", "turn", "head", "core", "hi", "lo")}
    for base in range(0, len(text) - MATCH + 1, PIECE):
        piece = text[base : base + PIECE + MATCH - 1]
        data = np.frombuffer(piece, dtype=np.uint8)
        cores = string_hashes(data, CORE)
        place = np.arange(len(cores), dtype=np.uint64)
        # the lowest hash, of equal ones the first
        anchor = (sliding_minimum(cores & ~_PLACE | place, MATCH - CORE + 1) & _PLACE).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        windows = np.diff(np.append(start, len(anchor)))
        ends = start + windows + MATCH - 1
        digests = b"".join([xxhash.xxh3_128_digest(piece[a:b]) for a, b in zip(start.tolist(), ends.tolist(), strict=True)])
        hashes = np.frombuffer(digests, dtype=">i8").astype(np.int64).reshape(-1, 2)
        first = data[anchor[start][:, None] + np.arange(8)].copy().view(">u8").ravel()
        found["start"].append(start + base)
        found["windows"].append(windows)
        found["turn"].append(anchor[start] - start)
        found["head"].append((first ^ np.uint64(1 << 63)).astype(np.uint64).view(np.int64))  # sorts as the bytes do
        found["core"].append(cores[anchor[start]].view(np.int64))
        found["hi"].append(hashes[:, 0])
        found["lo"].append(hashes[:, 1])
    return {name: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64) for name, parts in found.items()}


def joined_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans that neither touch nor overlap, covering the same bytes."""
    if not len(begins):
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    return begins[new], ends[np.concatenate([new[1:], [True]])]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ka, kb, text): texts as bytes, with 128 bits that stand for them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text).alias("ka"), F.xxhash64(F.lit(1), text).alias("kb"), text.cast("binary").alias("text")
    )


def indexed(docs: DataFrame) -> DataFrame:
    """(doc_id, ka, kb, n_bytes, sha256, runs, own): the different runs of each text, and the spans that repeat within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, columns = [], {name: [] for name in ("start", "windows", "turn", "head", "core", "hi", "lo", "copies")}
            lengths, hashes, own_sizes, own_begins, own_ends = [], [], [], [], []
            for value in batch.column(3):
                text = value.as_py()
                lengths.append(len(text))
                hashes.append(hashlib.sha256(text).hexdigest())
                runs = runs_of(text)
                _, first, same, copies = np.unique(np.stack([runs["hi"], runs["lo"]]), axis=1, return_index=True, return_inverse=True, return_counts=True)
                often = copies[same.ravel()] > 1
                begins, ends = joined_spans(runs["start"][often], (runs["start"] + runs["windows"] + MATCH - 1)[often])
                runs["copies"] = copies[same.ravel()]
                first = np.sort(first)
                sizes.append(len(first))
                for name, parts in columns.items():
                    parts.append(runs[name][first])
                own_sizes.append(len(begins))
                own_begins.append(begins)
                own_ends.append(ends)
            fields = {name: pa.array(np.concatenate(parts), pa.int32() if name in ("start", "windows", "turn", "copies") else pa.int64()) for name, parts in columns.items()}
            spans = {name: pa.array(np.concatenate(parts), pa.int32()) for name, parts in (("begin", own_begins), ("end", own_ends))}
            yield pa.record_batch(
                [
                    *batch.columns[:3], pa.array(lengths, pa.int64()), pa.array(hashes),
                    _lists(sizes, fields), _lists(own_sizes, spans),
                ],
                ["doc_id", *TEXT_KEY, "n_bytes", "sha256", "runs", "own"],
            )

    schema = f"doc_id long, ka long, kb long, n_bytes long, sha256 string, runs array<{RUN}>, own array<{SPAN}>"
    return docs.mapInArrow(run, schema)


def _lists(sizes: list[int], fields: dict[str, pa.Array]) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(fields.values()), list(fields)))


class SuffixLevels:
    """The index: suffix arrays of 1, 2, 4 ... batches, and the cores known to occur more than once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: dict[int, tuple[str, DataFrame]] = {}
        self.found: list[DataFrame] = []

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index a batch (head, core, copies); returns the cores of the batch or of older ones that are now known to repeat."""
        size, fresh = 1, self._array(suffixes)
        array, news = fresh, [fresh[1].where("copies > 1")]
        merged = []
        while size in self.levels:  # equal sizes merge, the smallest first
            merged += [array, self.levels.pop(size)]
            array, size = self._array(merged[-2][1].unionByName(merged[-1][1])), 2 * size
            news.append(array[1].where("copies > 1"))
        for _, level in self.levels.values():
            news.append(fresh[1].join(level.select("head", "core"), ["head", "core"]))
        self.levels[size] = array
        cores = functools.reduce(DataFrame.unionByName, [df.select("core") for df in news]).distinct()
        self.found.append(keep(cores, "suffix-repeated"))
        for path, _ in merged:
            delete_folder(self.spark, path)
        return self.found[-1]

    def repeated(self) -> DataFrame:
        """(core): all cores that occur more than once."""
        return functools.reduce(DataFrame.unionByName, self.found).distinct()

    def _array(self, suffixes: DataFrame) -> tuple[str, DataFrame]:
        path = workspace(self.spark, "suffix-array")
        array = suffixes.groupBy("head", "core").agg(F.sum("copies").alias("copies")).sortWithinPartitions("head", "core")
        return path, stored(array, path)


def repeated_spans(texts: DataFrame, docs: DataFrame, cores: DataFrame, dense: int) -> DataFrame:
    """(ka, kb, begin, end): the spans of windows that occur elsewhere, spans within one text alone left out."""
    runs = texts.select("doc_id", *TEXT_KEY, F.explode("runs").alias("r")).select("doc_id", *TEXT_KEY, "r.*").drop("head")
    runs = keep(runs.where(filter_of(cores, "core")).join(cores, "core"), "suffix-runs")
    whole, partly = stretch_kinds(runs, [*TEXT_KEY, "doc_id", "start", "windows", "turn"])
    return whole.unionByName(compared(keep(stretch_texts(docs, partly), "suffix-pieces"), dense, CUTS))


def stretch_kinds(runs: DataFrame, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """Spans of the stretches that occur twice; and one place of each different stretch of the cores that have several."""
    stretches = keep(runs.groupBy(*STRETCH_KEY).agg(F.sum("copies").alias("copies"), F.min(F.struct(*place)).alias("at")), "suffix-stretches")
    often = stretches.where("copies > 1").select(*STRETCH_KEY)
    end = F.col("start") + F.col("windows") + F.lit(MATCH - 1)
    whole = runs.join(often, STRETCH_KEY).select(*TEXT_KEY, F.col("start").alias("begin"), end.alias("end"))
    kinds = stretches.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return whole, stretches.join(kinds, "core").select(*STRETCH_KEY, "kinds", "copies", "at.*")


def compared(pieces: DataFrame, dense: int, cuts: tuple[int, ...]) -> DataFrame:
    """(ka, kb, begin, end): the repeated windows of stretches that differ around equal cores."""
    few, many = pieces.where(F.col("kinds") <= dense), pieces.where(F.col("kinds") > dense)
    parts = max(-(-few.count() // TOGETHER), 1)
    here = few.groupBy(F.pmod(F.xxhash64("core"), F.lit(parts)).alias("part")).applyInPandas(compare_stretches, "ka long, kb long, begin int, end int")
    if not cuts or many.isEmpty():
        return here
    runs = keep(cut_stretches(many.dropDuplicates(["core", *TEXT_KEY, "start"]), cuts[0]), "suffix-cut")
    place = [*TEXT_KEY, "start"]
    whole, partly = stretch_kinds(runs, place)
    rest = runs.join(partly.select(*STRETCH_KEY, *place, "kinds", F.col("copies").alias("all")), [*STRETCH_KEY, *place])
    rest = keep(rest.select("core", "kinds", F.col("all").alias("copies"), *place, "turn", "piece"), "suffix-pieces")
    return here.unionByName(whole).unionByName(compared(rest, dense, cuts[1:]))


def stretch_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(core, kinds, copies, ka, kb, start, turn, piece): the bytes of the wanted stretches."""
    each = F.struct("core", "kinds", "copies", "start", "windows", "turn")
    lists = wanted.groupBy(*TEXT_KEY, "doc_id").agg(F.collect_list(each).alias("wanted"))
    lists = keep(lists, "suffix-wanted").withColumnRenamed("doc_id", "id")
    found = docs.where(filter_of(lists, "ka")).join(lists, (docs["ka"] == lists["ka"]) & (docs["kb"] == lists["kb"]) & docs["doc_id"].eqNullSafe(lists["id"]))
    found = found.select(docs["ka"], docs["kb"], "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ka, kb, text, wanted in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for w in wanted:
                    piece = text[w["start"] : w["start"] + w["windows"] + MATCH - 1]
                    rows.append((w["core"], w["kinds"], w["copies"], ka, kb, w["start"], w["turn"], piece))
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            names = ["core", "kinds", "copies", *TEXT_KEY, "start", "turn", "piece"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return found.mapInArrow(run, "core long, kinds long, copies long, ka long, kb long, start int, turn int, piece binary")


def piece_windows(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the pieces: hash, number of the piece, place in it."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    windows = np.maximum(sizes - MATCH + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), windows)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    hashes = string_hashes(np.frombuffer(b"".join(pieces), dtype=np.uint8), MATCH)
    return hashes[np.repeat(np.cumsum(sizes) - sizes, windows) + place], piece, place


def compare_stretches(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans of the stretches without a copy whose windows occur in another stretch of the same core."""
    pdf = pdf.drop_duplicates(["core", *TEXT_KEY, "start"])  # repeated rows
    hashes, piece, place = piece_windows(pdf["piece"].to_list())
    core = pdf["core"].to_numpy()
    pairs = np.empty(len(hashes), dtype=[("core", np.int64), ("window", np.uint64)])
    pairs["core"], pairs["window"] = core[piece], hashes
    order = np.lexsort((hashes, core[piece]))
    ordered = pairs[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    number = np.empty(len(hashes), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    total = np.bincount(number, weights=pdf["copies"].to_numpy()[piece])
    again = (total[number] > 1) & (pdf["copies"].to_numpy()[piece] == 1)
    # stretches of neighbouring places
    piece, place = piece[again], place[again]
    first = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)])) if len(piece) else piece
    last = np.append(first[1:], len(piece)) - 1
    begin = pdf["start"].to_numpy()[piece[first]] + place[first]
    end = pdf["start"].to_numpy()[piece[first]] + place[last] + MATCH
    owner = piece[first]
    return pd.DataFrame({"ka": pdf["ka"].to_numpy()[owner], "kb": pdf["kb"].to_numpy()[owner], "begin": begin, "end": end})


def cut_stretches(pieces: DataFrame, width: int) -> DataFrame:
    """Runs of at most `width` windows; where a run ends depends on the distance to the anchor alone.

    The core of a run is what all its windows would share if it had `width` of them, so that runs
    that the ends of a stretch have shortened meet the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for core, copies, ka, kb, start, turn, piece in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                windows, at = len(piece) - MATCH + 1, 0
                while at < windows:
                    least = (turn - at) // width * width  # distance of the run's last window
                    upto = min(turn - least + 1, windows)
                    inner = piece[turn - least : turn - least + MATCH - width + 1]
                    part = piece[at : upto + MATCH - 1]
                    hashes = np.frombuffer(xxhash.xxh3_128_digest(part), dtype=">i8").tolist()
                    longer = xxhash.xxh3_64_intdigest(inner, core & (1 << 64) - 1) - (1 << 63)
                    rows.append((longer, *hashes, copies, ka, kb, start + at, upto - at, turn - at, part))
                    at = upto
            kinds = [pa.int64()] * 6 + [pa.int32()] * 3 + [pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 10
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = [*STRETCH_KEY, "copies", *TEXT_KEY, "start", "windows", "turn", "piece"]
    schema = "core long, hi long, lo long, copies long, ka long, kb long, start int, windows int, turn int, piece binary"
    return pieces.select("core", "copies", *TEXT_KEY, "start", "turn", "piece").mapInArrow(run, schema)


def removed_spans(spans: DataFrame) -> DataFrame:
    """(ka, kb, spans, n_removed, n_spans): the spans of each text joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = [], []
            for spans in batch.column(2):
                values = spans.values
                begin, end = joined_spans(values.field("begin").to_numpy(), values.field("end").to_numpy())
                begins.append(begin)
                ends.append(end)
            sizes = [len(b) for b in begins]
            removed = [int((e - b).sum()) for b, e in zip(begins, ends, strict=True)]
            fields = {"begin": pa.array(np.concatenate(begins), pa.int32()), "end": pa.array(np.concatenate(ends), pa.int32())}
            yield pa.record_batch(
                [*batch.columns[:2], _lists(sizes, fields), pa.array(removed, pa.int64()), pa.array(sizes, pa.int64())],
                [*TEXT_KEY, "spans", "n_removed", "n_spans"],
            )

    lists = spans.distinct().groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return lists.mapInArrow(run, f"ka long, kb long, spans array<{SPAN}>, n_removed long, n_spans long")


def find_repeats(docs: DataFrame, batches: int = BATCHES, dense: int = DENSE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, keys, spans): what `indexed` gives, the documents with their keys, and what `removed_spans` gives."""
    docs = keyed(docs)
    texts = keep(indexed(docs), "suffix-texts")
    index = SuffixLevels(docs.sparkSession)
    for number in range(batches):
        batch = texts.where(F.pmod(F.xxhash64("ka", "kb", F.lit(3)), F.lit(batches)) == number)
        index.add(batch.select(F.explode("runs").alias("r")).select("r.head", "r.core", "r.copies"))
    cores = keep(index.repeated(), "suffix-cores")
    for path, _ in index.levels.values():
        delete_folder(docs.sparkSession, path)
    own = texts.select(*TEXT_KEY, F.explode("own").alias("s")).select(*TEXT_KEY, "s.*")
    spans = repeated_spans(texts, docs, cores, dense).unionByName(own)
    return texts, docs, keep(removed_spans(spans), "suffix-spans")


def kept_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, kept, spans, n_removed, n_spans): what is left of the texts that have spans."""
    part = docs.where(filter_of(spans, "ka")).join(spans, TEXT_KEY).select("doc_id", "text", "spans", "n_removed", "n_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                text, at, left = text.as_py(), 0, []
                for span in spans.as_py():
                    left.append(text[at : span["begin"]])
                    at = span["end"]
                kept.append(b"".join([*left, text[at:]]))
            yield pa.record_batch([batch.column(0), pa.array(kept, pa.binary()), *batch.columns[2:]], ["doc_id", "kept", "spans", "n_removed", "n_spans"])

    return part.mapInArrow(run, f"doc_id long, kept binary, spans array<{SPAN}>, n_removed long, n_spans long")


def digest(docs: DataFrame, batches: int = BATCHES, dense: int = DENSE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row per document."""
    texts, docs, spans = find_repeats(docs, batches, dense)
    judged = texts.select("doc_id", *TEXT_KEY, "n_bytes", "sha256").join(spans.drop("spans"), TEXT_KEY, "left")
    removed, number = (F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in ("n_removed", "n_spans"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    clear = judged.where(F.col("n_removed").isNull() | (F.col("n_removed") == F.col("n_bytes")))
    clear = clear.select("doc_id", "n_bytes", removed, number, F.when(F.col("n_removed").isNull(), F.col("sha256")).otherwise(empty).alias("kept_sha256"))
    # a text that is not removed whole has no copy
    some = judged.where("n_removed < n_bytes").select(*TEXT_KEY).join(spans, TEXT_KEY)
    left = kept_texts(docs, keep(some, "suffix-partly"))
    n_bytes = F.length("kept").cast("long") + F.col("n_removed")
    left = left.select("doc_id", n_bytes.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return clear.unionByName(left)


REPEATS_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), places AS (
  SELECT r, unnest(range(n - {MATCH} + 1)) AS p FROM texts WHERE n >= {MATCH}
), windows AS (
  SELECT r, p, md5_number(substring(h, 2 * p + 1, {2 * MATCH})) AS w FROM places JOIN texts USING (r)
), again AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
  FROM (SELECT r, p, count(*) OVER (PARTITION BY w) AS c FROM windows) WHERE c > 1
), marked AS (
  SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + {MATCH} THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS span FROM again
), spans AS (
  SELECT r, min(p) AS begin, max(p) + {MATCH} AS stop FROM marked GROUP BY r, span
), gaps AS (
  SELECT r, begin, stop, lag(stop, 1, 0) OVER (PARTITION BY r ORDER BY begin) AS free FROM spans
), removed AS (
  SELECT r, sum(stop - begin) AS n_removed, count(*) AS n_spans, max(stop) AS last,
         string_agg(substring(h, 2 * free + 1, 2 * (begin - free)), '' ORDER BY begin) AS kept
  FROM gaps JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN removed USING (r)
"""
