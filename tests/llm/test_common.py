from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.llm import common


def test_kept_tables_go_when_a_block_is_done(spark):
    outside = common.keep(spark.range(3), "outside")
    with common.swept(spark):
        inside = common.keep(spark.range(4), "inside")
        files = [Path(f.removeprefix("file://").removeprefix("file:")) for f in inside.inputFiles()]
        assert inside.count() == 4 and all(f.exists() for f in files)
    assert not any(f.exists() for f in files)
    assert outside.count() == 3
    with pytest.raises(RuntimeError), common.swept(spark):
        failed = common.keep(spark.range(5), "failed")
        raise RuntimeError
    assert failed.count() == 5


def test_folds_and_words(spark):
    import zlib

    from pyspark.sql import functions as F

    ids = [0, 7, 12345678901, None]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", common.fold_zero(F.col("i"), 5).alias("z")).collect()
    assert {r.i: r.z for r in rows} == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0 for i in ids}
    assert common.words_of("A\tb\x0bC\u00a0\u00c9 d") == [b"a", b"b", "c\u00a0\u00c9".encode(), b"d"]
    assert common.words_of(None) == common.words_of(" ") == []


def test_filters_let_all_wanted_values_pass(spark):
    values = spark.range(-500, 500).select((F.col("id") * 7919 * 7919 * 104729).alias("ka"))
    test = common.filter_of(values, "ka")
    assert values.where(test).count() == 1000
    others = spark.range(200000, 300000).select((F.col("id") * 7919 * 7919 * 104729 + 1).alias("ka"))
    assert others.where(test).count() < 100
