import zlib

import numpy as np
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.bpe import Encoder, vocabulary

SCHEMA = "doc_id long, text string, start string, offset int"
ODD = ["\n", " ", "a\n", "\nb", " c", "d ", "e\nf g\nh", "i\n\nj", "k \nl", "it's 12,5% \u00e9t\u00e9 \u4f60\u597d", "", None, "a", "  two  spaces\n\n\tand tab ", "x\x1cy !\x1c z", "non\xa0breaking \xa0 space x", "end <|endoftext|> mark", "z" * 3000]


TOKENIZER = Tokenizer.from_file(vocabulary())


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_like_whole_texts():
    encoder = Encoder(vocabulary())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(ODD)] == [whole(t) for t in ODD]


def check(rows, docs):
    """Every id once, windows gapless, lengths 1024 or a power of two, checksums right."""
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs.items():
        ids = np.array([*whole(text), 0], "<u4")
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0


def test_every_id_lies_in_one_piece(spark):
    docs = {i: t for i, t in enumerate([*ODD, *("word " * n for n in range(1, 400, 7)), "long text. " * 4000])}
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs.items()], SCHEMA).repartition(3)
    check(packing.pack(df).collect(), docs)


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(df).collect()
    check(rows, {r.doc_id: r.text for r in df.collect()})
    used = len({r.sequence_id for r in rows}) * 1024
    assert sum(r.length for r in rows) > 0.97 * used


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b", "", 0), (1, "a b", "", 0), (None, "a b", "", 0)], SCHEMA)
    assert sorted(r.doc_id or 0 for r in packing.pack(df).collect() if r.start == 0) == [0, 1, 1]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sum_of_squares_choice():
    packer = packing.Packer(8, 0)
    packer.level[:] = [0, 0, 3, 0, 1, 0, 2, 0, 0]
    # size 2: into 6 closes a window (1 - 4 = -3), into 2 gives 2 (1 - 3) + 2 = -2
    assert packer._best(2) == 6
    packer.level[6] = 0
    assert packer._best(2) == 2
    # size 5 fits nowhere but level 2; a new window costs 1, level 2 to 7 costs 2 (0 - 3) + 2
    assert packer._best(5) == 2


def test_open_windows_grow_slowly():
    """Far fewer open windows than documents, although every size is equally frequent."""
    packer = packing.Packer(1024, 0)
    for i, n in enumerate(np.random.default_rng(1).integers(1, 1024, 20_000)):
        packer.add(i, bytes(4 * int(n)))
    assert packer.level.sum() < 20_000 / 6
    assert packer.level.sum() == sum(map(len, packer.open))
