import corpus_pipeline
import pytest

import __spark_entry__ as entry_point
from millrace.llm import decontamination, secrets, simhash, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark, tmp_path):
    """Each stage keeps the columns, and what it drops is what its operator finds in its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        kept = spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert kept.columns == columns
        before, after = (set(r[0] for r in d.select("doc_id").collect()) for d in (docs, kept))
        if name == "toxicity":
            labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
            assert after == {r.doc_id for r in toxicity.score(docs, labels).collect() if not r.predicted}
        elif name == "near_duplicates":
            assert after == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        elif name == "decontamination":
            items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            assert after == {r.doc_id for r in decontamination.find_leaks(docs, items).collect() if not r.contaminated}
        elif name == "secrets":
            assert after == before
            found = {r.doc_id for r in secrets.find_secrets(docs).collect() if r.is_secret}
            old, new = ({r.doc_id: r.text for r in d.collect()} for d in (docs, kept))
            assert {d for d in old if old[d] != new[d]} == found
        else:
            assert after == before
        docs = kept


def test_run_and_registration(spark):
    queries = entry_point.queries()
    assert queries["pipeline"](spark, "/root/testdata/sf0.001").count() > 0
    assert sorted(n for n in queries if n.startswith("op")) == sorted(
        ["op1_toxicity", "op2_packing", "op3_hmm", "op4_token_scan", "op5_simhash", "op6_nndescent", "op7_resampling", "op8_pii", "op9_decontamination", "op10_secrets",
         "op11_suffix_levels", "op12_anchor_lists", "op13_mask_ranking"]
    )


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_unusual_rows(spark, stage):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "long " * 20_000, "en", "s", 1)]
    for data in (rows, []):
        out = stage[1](spark, spark.createDataFrame(data, schema), FOLDER)
        assert out.columns == schema.names
        assert len(out.collect()) <= len(data)
