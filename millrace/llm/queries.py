"""The registered queries op1 ... op13: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    anchor_lists,
    decontamination,
    hmm,
    mask_ranking,
    nndescent,
    packing,
    pii,
    resampling,
    secrets,
    simhash,
    suffix_levels,
    token_scan,
    toxicity,
)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_hmm(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score(table(spark, folder, "documents"))


def op4_token_scan(spark: SparkSession, folder: str) -> DataFrame:
    return token_scan.count_tokens(table(spark, folder, "documents"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_nndescent(spark: SparkSession, folder: str) -> DataFrame:
    return nndescent.neighbours(table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op7_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


def op11_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_levels.digest(table(spark, folder, "documents"))


def op12_anchor_lists(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = anchor_lists.integer_vector(F.col("embedding"), 256)
    return anchor_lists.mine(table(spark, folder, "embeddings"), "vec_id", vectors, label, vec_id % 100 == 0)


def op13_mask_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return mask_ranking.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_hmm": op3_hmm,
    "op4_token_scan": op4_token_scan,
    "op5_simhash": op5_simhash,
    "op6_nndescent": op6_nndescent,
    "op7_resampling": op7_resampling,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_suffix_levels": op11_suffix_levels,
    "op12_anchor_lists": op12_anchor_lists,
    "op13_mask_ranking": op13_mask_ranking,
}
SQL: dict[str, str] = {
    "op11_suffix_levels": suffix_levels.REPEATS_SQL,
    "op12_anchor_lists": anchor_lists.MINE_SQL,
    "op13_mask_ranking": mask_ranking.RANK_SQL,
}
