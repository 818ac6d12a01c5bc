import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_scan
from millrace.llm.bpe import vocabulary

SCHEMA = "doc_id long, text string, file string, ordinal int"


def plain(stream, end):
    """Documents of one stream, one token after the other."""
    out, start = [], 0
    for i, t in enumerate(stream):
        if t == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(stream):
        out.append((len(out), start, len(stream) - start, False))
    return out


def streams():
    rng = np.random.default_rng(4)
    yield "a", rng.integers(0, 9, 5000)
    yield "b", np.array([7] * 300)  # one long document, never closed
    yield "c", np.array([0] * 40)  # empty documents only
    yield "d", np.array([5, 0])
    yield "e", np.concatenate([np.full(999, 3), [0], np.full(2000, 4), [0]])


@pytest.mark.parametrize(("block", "run"), [(1, 3), (7, 2), (64, 1024), (10_000, 4)])
def test_blocks_are_stitched(spark, block, run, monkeypatch):
    monkeypatch.setattr(token_scan, "RUN", run)
    rows = [
        (name, i // block, np.asarray(s[i : i + block]).astype("<u2").tobytes(), "extra")
        for name, s in streams()
        for i in range(0, len(s), block)
        if block > 1 or name != "a"
    ]
    rows += [("d", 99, b"", "extra"), ("z", 0, None, "extra")]
    blocks = spark.createDataFrame(rows, "file string, block long, payload binary, tokens string").repartition(5)
    got = {}
    for r in token_scan.documents(blocks, 0).collect():
        got.setdefault(r.file, []).append((r.ordinal, r.start, r.tokens, r.closed))
    want = {name: plain(s.tolist(), 0) for name, s in streams() if block > 1 or name != "a"}
    assert {name: sorted(rows) for name, rows in got.items()} == want


def test_files_on_disk(spark, tmp_path):
    stream = np.random.default_rng(1).integers(0, 50, 3001)
    stream.astype("<u4").tofile(tmp_path / "one.bin")
    np.array([], dtype="<u4").tofile(tmp_path / "none.bin")
    blocks = token_scan.read_token_files(spark, str(tmp_path), "<u4", block_tokens=256)
    got = sorted((r.ordinal, r.start, r.tokens, r.closed) for r in token_scan.documents(blocks, 0, "<u4").collect())
    assert got == plain(stream.tolist(), 0)


def test_sample_table(spark, monkeypatch):
    monkeypatch.setattr(token_scan, "BLOCK_TOKENS", 1000)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(vocabulary())
    want = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) for r in df.collect()}
    rows = token_scan.count_tokens(df.repartition(3)).collect()
    assert {r.doc_id: r.tokens for r in rows} == want and len(rows) == len(want)


def test_unusual_documents(spark):
    data = [(1, None, "", 0), (2, "", "", 0), (3, "a b", "", 0), (3, "a b", "", 0), (None, "x<|endoftext|>y", "", 0), (4, "long " * 40_000, "", 0)]
    rows = token_scan.count_tokens(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.tokens) for r in rows) == [(0, 2), (1, 0), (2, 0), (3, 2), (3, 2), (4, 40_001)]
    assert token_scan.count_tokens(spark.createDataFrame([], SCHEMA)).collect() == []
